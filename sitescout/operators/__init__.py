"""The analytics operators, DataFrame in and DataFrame out."""
