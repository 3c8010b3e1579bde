"""What the planning of joins has to know of a table, gathered while the table is written.

A profile holds the rows of a table, the bytes of its columns and, for its join keys, a
sketch of the most frequent values. Spark merges the sketches of all writing tasks and adds
the result to the write's own metrics, so no row is read again.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Values that a sketch follows, and values that it reports. Its map has a power of two of
#: places, a third more than the values; counts are wrong by 3.5 rows in so many at most, and
#: values with more than twice that share are reported without fail.
TRACKED = 12288
REPORTED = 1000
_MISSED = 2 * 3.5 / 16384


@dataclass(frozen=True)
class Frequent:
    """Rows of the most frequent values of a key (None: NULL); no other has over ``others``."""

    rows: int
    counts: Mapping[object, int]
    others: int

    def above(self, parts: int, share: float, nulls: bool = True) -> dict[object, int] | None:
        """Keys with more rows than ``share`` of the ``parts`` equal parts of all rows, and the
        number of such parts that they fill; None if the sketch may have missed one."""
        total = self.rows if nulls else self.rows - self.counts.get(None, 0)
        limit = share * total / parts
        if limit < self.others:
            return None
        return {
            value: math.ceil(n * share / limit) for value, n in self.counts.items()
            if n > limit and (nulls or value is not None)
        }


@dataclass(frozen=True)
class Profile:
    """Rows of a table, payload bytes of its text columns, frequent values of its keys."""

    rows: int
    bytes: Mapping[str, int] = field(default_factory=dict)
    keys: Mapping[str, Frequent] = field(default_factory=dict)

    def size(self, columns: list[str], fixed: int = 0) -> int:
        """Bytes of these text columns and ``fixed`` others, at eight bytes for each value."""
        values = sum(self.bytes.get(name, 0) for name in columns)
        return values + 8 * (len(columns) + fixed) * self.rows

    def as_json(self) -> dict:
        keys = {
            name: {"rows": f.rows, "counts": list(f.counts.items()), "others": f.others}
            for name, f in self.keys.items()
        }
        return {"rows": self.rows, "bytes": dict(self.bytes), "keys": keys}

    @classmethod
    def from_json(cls, stored: dict) -> Profile:
        keys = {
            name: Frequent(f["rows"], {value: n for value, n in f["counts"]}, f["others"])
            for name, f in stored["keys"].items()
        }
        return cls(stored["rows"], stored["bytes"], keys)


class Observed:
    """A DataFrame that is profiled by the action that computes it.

    ``keys``: text expressions by the name under which their values are profiled.
    """

    def __init__(self, df: DataFrame, keys: Mapping[str, Column]):
        texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
        sizes = [
            F.sum(F.octet_length(F.col(name)).cast("long")).alias(f"bytes {name}") for name in texts
        ]
        sketches = [
            F.to_json(
                F.call_function("approx_top_k", key, F.lit(REPORTED), F.lit(TRACKED))
            ).alias(f"top {name}")
            for name, key in keys.items()
        ]
        self._texts, self._keys = texts, list(keys)
        self._observation = Observation()
        rows = F.count(F.lit(1)).alias("rows")
        self.df = df.observe(self._observation, rows, *sizes, *sketches)

    def profile(self) -> Profile:
        """The profile, once the action has ended."""
        found = self._observation.get
        rows = found.get("rows") or 0
        if not rows:
            return Profile(0, {}, {name: Frequent(0, {}, 0) for name in self._keys})
        keys = {}
        for name in self._keys:
            listed = json.loads(found[f"top {name}"] or "[]")
            counts = {one.get("item"): one["count"] for one in listed}
            others = math.ceil(_MISSED * rows)
            if len(counts) >= REPORTED:
                others = max(others, min(counts.values()))
            keys[name] = Frequent(rows, counts, others)
        return Profile(rows, {name: found[f"bytes {name}"] or 0 for name in self._texts}, keys)
