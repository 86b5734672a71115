"""Test tables of this folder."""

SF = "/root/testdata/sf0.001"
CLASHING = ("row", "node", "key", "n", "value", "text_key", "label", "gram", "part", "_row", "_key",
            "kept", "score", "tokens", "unit", "cluster")


def wide(df):
    """The same rows among columns whose names operators might use themselves."""
    from pyspark.sql import functions as F
    return df.select(*[F.lit("x").alias(c) for c in CLASHING if c not in df.columns], *df.columns)
