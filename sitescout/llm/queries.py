"""The corpus operators as queries over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitescout.llm import (
    alignment,
    decontaminate,
    fingerprints,
    language_id,
    line_dedup,
    mixture,
    near_dedup,
    passages,
    periodicity,
    sharding,
    suffix_dedup,
    token_counts,
    toxicity,
)
from sitescout.llm.common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    return cut.select("doc_id", "n_lines", "n_removed", "n_spans", kept)


def op4_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=2, threshold=0.8)


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op6_bwt_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.repeated_passages(table(spark, sf_dir, "documents"))
    ranges = F.transform("passages", lambda p: F.concat_ws("-", p["start"].cast("string"), p["stop"].cast("string")))
    return found.select("doc_id", "n_passages", "n_repeated_words", F.array_join(ranges, ",").alias("passages"), "other_id")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = language_id.identify(docs.select("doc_id", "text"), language_id.train(docs))
    return judged.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), *paths)


def op12_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), shards=8)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodicity.periodic_runs(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_toxicity": op2_toxicity,
    "op3_line_dedup": op3_line_dedup,
    "op4_hyperminhash": op4_hyperminhash,
    "op5_order_minhash": op5_order_minhash,
    "op6_bwt_merge": op6_bwt_merge,
    "op7_decontamination": op7_decontamination,
    "op8_compact_windows": op8_compact_windows,
    "op9_source_mix": op9_source_mix,
    "op10_language_id": op10_language_id,
    "op11_token_alignment": op11_token_alignment,
    "op12_minimax_shards": op12_minimax_shards,
    "op13_periodic_runs": op13_periodic_runs,
}

LINE_DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, l, unnest(range(0, len(l) - 2)) AS s FROM d WHERE len(l) >= 3),
k AS (SELECT doc_id, s, l[s + 1] || chr(10) || l[s + 2] || chr(10) || l[s + 3] AS k FROM w),
n AS (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS nth
      FROM k WHERE regexp_replace(k, '\s', '', 'g') <> ''),
gone AS (SELECT DISTINCT doc_id, s + unnest([0, 1, 2]) AS i FROM n WHERE nth > 1),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(0, len(l))) AS i FROM d),
marked AS (SELECT doc_id, line, i, g.i IS NOT NULL AS is_gone FROM lines LEFT JOIN gone g USING (doc_id, i)),
runs AS (SELECT *, is_gone AND NOT coalesce(lag(is_gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM marked),
agg AS (SELECT doc_id, count(*)::INT AS n_lines, (count(*) FILTER (is_gone))::INT AS n_removed,
        (count(*) FILTER (opens))::INT AS n_spans,
        string_agg(line, chr(10) ORDER BY i) FILTER (NOT is_gone) AS kept FROM runs GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN agg USING (doc_id)
"""

NEAR_DEDUP_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 80 * (na.n + nb.n - common)),
r AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a),
c AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s + 1 : s + least(len(w), 13)], ' ') AS phrase
      FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 13, 0) + 1)) AS s FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM p),
here AS (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, lengths WHERE len(w) >= n),
m AS (SELECT DISTINCT doc_id, s, n, item_id
      FROM (SELECT doc_id, s, n, array_to_string(w[s + 1 : s + n], ' ') AS phrase FROM here) JOIN p USING (n, phrase)),
hit AS (SELECT doc_id, count(DISTINCT i) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS i FROM m) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
          string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS listed FROM m GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SOURCE_MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
      source_size::DOUBLE * 2.0::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget FROM s),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS own
      FROM r WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, first_value(own) OVER (ORDER BY (cap < weight * own), cap / weight, own) AS level,
      min(cap < weight * own) OVER () AS all_held FROM l),
g AS (SELECT source, source_size, CASE WHEN all_held THEN cap ELSE least(cap, weight * level) END AS target FROM t),
j AS (SELECT doc_id, size, source_size, target,
      CASE WHEN source_size > 0 THEN least(target / source_size, 2.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate,
      ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + (u < rate - floor(rate))::INT))::BIGINT AS taken FROM j
"""

ORACLES: dict[str, str] = {
    "op3_line_dedup": LINE_DEDUP_SQL,
    "op4_hyperminhash": NEAR_DEDUP_SQL,
    "op7_decontamination": DECONTAMINATION_SQL,
    "op9_source_mix": SOURCE_MIX_SQL,
}
