"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

#: Maps A-Z to a-z and every ASCII byte that is neither letter nor digit to a
#: blank. Bytes of other characters stay, so words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` below the shared scratch folder and reads it back.

    Cuts the lineage; a lost executor costs no more than the stage it worked on.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names close to ``names`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of a key's text modulo ``divisor``; null for a null key."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % divisor


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the crc32 of an ASCII text that is not empty."""
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT))"
    bits = "list_prepend(xor(c, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[]))"
    step = f"list_reduce({bits}, lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {step}), 4294967295)"
