"""Deterministic order, sides and fingerprints from SHA-256."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha_rank(*parts: Column | str | int) -> Column:
    """A stable pseudo-random order key: the digest of the parts joined by colons."""
    return F.sha2(F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts]), 256)


def fingerprint(c: Column) -> Column:
    return F.sha2(c, 256)


def candidate_is_a(id_type: str, id_col: Column, candidate: Column, seed: int) -> Column:
    """Whether the candidate is shown as A: the first digest byte of the compact JSON key is even."""
    q = F.to_json(F.array(F.lit(id_type), id_col.cast("string"), candidate))
    payload = F.concat(F.substring(q, 1, F.length(q) - 1), F.lit(f",{seed}]"))
    return F.conv(F.substring(F.sha2(payload, 256), 1, 2), 16, 10).cast("int") % 2 == 0
