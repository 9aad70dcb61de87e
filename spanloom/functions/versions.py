"""Client versions of the form language-1.2.3."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The lowest accepted client version by language.
MINIMUM = {"go": "2.6.0", "python": "3.8.0", "node": "3.0.0", "java": "0.0.17"}
_FORM = r"^([^-]*)-([0-9]+([.][0-9]+)*)-*$"


def _at_least(parts: Column, minimum: str) -> Column:
    answer: Column = F.lit(True)
    for i, least in reversed(list(enumerate(int(p) for p in minimum.split(".")))):
        part = F.get(parts, F.lit(i)).try_cast("int")
        answer = F.when(F.size(parts) <= i, F.lit(True)).when(part.isNull() | (part < least), F.lit(False)).when(part > least, F.lit(True)).otherwise(answer)
    return answer


def version_at_least(version: Column, minimum: str) -> Column:
    """Whether a dotted version is at least ``minimum``: part by part up to the shorter length, equal
    so far is true; a part that is reached but is no int makes it false."""
    return _at_least(F.split(version, r"\."), minimum)


def meets_minimum(client_version: Column) -> Column:
    """Whether a client version has a known language and at least its minimum; null is false."""
    low = F.lower(client_version)
    read = F.struct(F.regexp_extract(low, _FORM, 1).alias("language"), F.split(F.regexp_extract(low, _FORM, 2), r"\.").alias("parts"))

    def answer(v: Column) -> Column:
        out: Column = F.lit(False)
        for name, least in MINIMUM.items():
            out = F.when(v["language"] == name, _at_least(v["parts"], least)).otherwise(out)
        return F.coalesce(F.when(F.get(v["parts"], F.lit(0)) != "", out), F.lit(False))

    # the lambda's variable holds what was read, so that each version is read once
    return F.get(F.transform(F.array(read), answer), F.lit(0))
