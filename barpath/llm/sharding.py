"""Operator 6, placement on shards through a permutation-filled lookup table.

Shards take turns claiming slots of a table of prime size, each in the order of its own permutation; a key's slot is a hash
of it. The table is as large as its ``slots``, whatever the corpus, so it is joined by broadcast; when a shard goes, about
its own slots change hands and few others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barpath.llm.common import table

#: A prime of over 100 slots a shard, and the shards of the registered query.
SLOTS = 65537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:12], 16)


def lookup_table(shards: Sequence[str], slots: int = SLOTS, weights: Sequence[int] | None = None) -> list[str]:
    """The shard of each slot. A shard of weight w claims w slots a turn. ``slots`` must be a prime over the number of shards."""
    names = sorted(set(shards))
    if not names:
        raise ValueError("no shards")
    if slots <= len(names) or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime larger than the number of shards")
    turns = dict(zip(shards, weights, strict=True)) if weights else {}
    if turns and (min(turns.values()) < 0 or not any(turns.values())):
        raise ValueError("weights must not be negative, and one must be positive")
    at = {n: _number(f"offset:{n}") % slots for n in names}
    skip = {n: _number(f"skip:{n}") % (slots - 1) + 1 for n in names}
    out: list[str | None] = [None] * slots
    claimed = 0
    while claimed < slots:
        for n in names:
            for _ in range(turns.get(n, 1)):
                if claimed == slots:
                    break
                while out[at[n]] is not None:
                    at[n] = (at[n] + skip[n]) % slots
                out[at[n]] = n
                claimed += 1
    return out


def place(df: DataFrame, key: str, shards: Sequence[str] = SHARDS, slots: int = SLOTS, weights: Sequence[int] | None = None) -> DataFrame:
    """All columns of ``df``, ``slot`` (long) and ``shard``. No shuffle: the table is broadcast, with a row for each slot.

    The slot is the first 60 bits of the md5 of the key as text, mod the number of slots, so equal keys meet on one shard;
    a null key counts as the empty text. Every row stays. Columns ``slot`` and ``shard`` are replaced.
    """
    table_ = df.sparkSession.createDataFrame(list(enumerate(lookup_table(shards, slots, weights))), "slot long, shard string")
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    slot = F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots).cast("long"))
    names = [c for c in df.columns if c not in ("slot", "shard")]
    return df.select(*names, slot.alias("slot")).join(F.broadcast(table_), "slot").select(*names, "slot", "shard")


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    return place(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")


def oracle_sql() -> str:
    """The same placement in SQL, over the table as a list."""
    names = sorted(set(SHARDS))
    numbers = ",".join(str(names.index(s)) for s in lookup_table(SHARDS))
    slot = f"(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT % {SLOTS})"
    return f"WITH t AS (SELECT [{numbers}]::INTEGER[] AS shards), d AS (SELECT doc_id, n_chars, {slot} AS slot FROM documents) SELECT doc_id, n_chars, slot, 'shard-' || lpad(CAST(shards[slot + 1] AS VARCHAR), 3, '0') AS shard FROM d, t"
