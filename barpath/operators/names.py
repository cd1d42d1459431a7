"""Athletes found by a name, a part of one or a membership number: trigrams counted by blocks. SURVEY STR-4, SRT-1."""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barpath.functions.text import similarity, trigrams
from barpath.session import materialise

#: Of the trigrams of two names, more than one in this many must be shared.
SHARE = 5
TOP = 50
#: Terms and names that meet in a task, about, and names that are counted at a time.
TERMS, NAMES, CHUNK = 1 << 12, 1 << 14, 1 << 8
#: Tasks at most.
TASKS = 1 << 12


def _best_of_block(names: pd.DataFrame, terms: pd.DataFrame, top: int) -> pd.DataFrame:
    """term_id, athlete_name, other (not the very name) and similarity: the ``top`` names of a block for each term of a block that are similar
    to it or contain it. Shared trigrams of all pairs are counted from the lists of the terms that have a trigram."""
    names = names.sort_values("athlete_name", ignore_index=True)
    grams = pd.Index(np.unique(np.concatenate([[""], *terms["t"]]).astype(object)))
    own = np.array([len(t) for t in terms["t"]])
    at = grams.get_indexer(np.concatenate([[""], *terms["t"]])[1:])
    order = np.argsort(at, kind="stable")
    lists, starts = np.repeat(np.arange(len(terms)), own)[order], np.searchsorted(at[order], np.arange(len(grams) + 1))
    low, asked = names["low"].tolist(), terms["low"].tolist()
    text, ends = "\n".join(low), np.cumsum([len(x) + 1 for x in low]).tolist()
    inside: dict[int, list[int]] = {}
    for j, term in enumerate(asked):
        if "\n" in term:
            hits = [i for i, x in enumerate(low) if term in x]
        else:
            hits, place = [], text.find(term) if term else -1
            while place >= 0:
                i = bisect.bisect_right(ends, place)
                if term in low[i]:
                    hits.append(i)
                place = text.find(term, ends[i])
        for i in hits:
            inside.setdefault(i, []).append(j)
    found = []
    for first in range(0, len(names), CHUNK):
        part = names["t"].iloc[first : first + CHUNK]
        size = np.array([len(t) for t in part])
        g = grams.get_indexer(np.concatenate([[""], *part])[1:])
        row = np.repeat(np.arange(len(part)), size)[g >= 0]
        g = g[g >= 0]
        n = starts[g + 1] - starts[g]
        term = lists[np.repeat(starts[g] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())] if len(g) else np.zeros(0, np.int64)
        both = np.bincount(np.repeat(row, n) * len(terms) + term, minlength=len(part) * len(terms)).reshape(len(part), len(terms))
        alike = both / np.maximum(size[:, None] + own[None, :] - both, 1)
        keep = alike > 1 / SHARE
        for i in range(len(part)):
            keep[i, inside.get(first + i, [])] = True
        i, j = np.nonzero(keep)
        found.append((j, i + first, alike[i, j]))
    j, i, alike = (np.concatenate(x) for x in zip(*found, strict=True))
    other = np.array([low[a] != asked[b] for a, b in zip(i.tolist(), j.tolist(), strict=True)], dtype=bool)
    order = np.lexsort((i, -alike, other, j))  # names are sorted: their number is their order
    j, i, alike, other = j[order], i[order], alike[order], other[order]
    keep = np.arange(len(j)) - np.searchsorted(j, j) < top
    j, i = j[keep], i[keep]
    return pd.DataFrame({"term_id": terms["term_id"].to_numpy()[j], "athlete_name": names["athlete_name"].to_numpy()[i], "other": other[keep], "alike": alike[keep]})


def similar(names: DataFrame, terms: DataFrame):
    """Distinct names and distinct terms, in the pairs of blocks where each name meets each term: similar ones are counted there."""
    n, m = names.count(), terms.count()
    name_blocks, term_blocks = -(-max(n, 1) // NAMES), -(-max(m, 1) // TERMS)
    block = lambda c, k: F.pmod(F.xxhash64(c), F.lit(k)).cast("long")
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    x = names.select("athlete_name", F.lower("athlete_name").alias("low"), trigrams("athlete_name").alias("t"), block("athlete_name", name_blocks).alias("nb"), every(term_blocks).alias("tb"))
    y = terms.select("term_id", F.lower("term").alias("low"), trigrams("term").alias("t"), block("term", term_blocks).alias("tb"), every(name_blocks).alias("nb"))
    tasks = min(name_blocks * term_blocks, TASKS)  # few bytes bring much work about: no partitions are put together
    of_blocks = lambda df: df.repartition(tasks, "nb", "tb").groupBy("nb", "tb")
    return of_blocks(x).cogroup(of_blocks(y))


def best_of(met, top: int, term_id: str) -> DataFrame:
    """(term_id, athlete_name): for each term the ``top`` of the names of ``similar`` that are similar to it (more than one trigram in ``SHARE``
    shared) or contain it, the very name first, then by falling similarity and name: athletes of other names come after those of ``top`` names.
    Each pair of blocks sends on its best, so no other pair of a name and a term leaves a task. ``term_id``: its type."""

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return _best_of_block(a, b, top) if len(a) and len(b) else pd.DataFrame({"term_id": [], "athlete_name": [], "other": [], "alike": []})

    found = met.applyInPandas(run, f"term_id {term_id}, athlete_name string, other boolean, alike double")
    place = F.row_number().over(Window.partitionBy("term_id").orderBy("other", F.desc("alike"), "athlete_name"))
    return found.withColumn("__k", place).where(F.col("__k") <= top).select("term_id", "athlete_name")


def search_athletes(people: DataFrame, recent: DataFrame, terms: DataFrame, top: int = TOP) -> DataFrame:
    """STR-4: for each term the ``top`` athletes whose name contains it, or is similar to it, or whose membership number it is:
    ``term_id``, ``place``, ``lifter_id``, ``athlete_name``, ``membership_number``, ``gender``, ``club_name``, ``wso``.

    ``people``: lifter_id, athlete_name, membership_number; ``recent``: lifter_id, gender, club_name, wso of the last result that has
    a club or a region; athletes without one, or whose club is null there, are not found. In this order: the membership number, the
    very name, the others; by falling similarity, name and id. A null term finds nothing, an empty one is contained in every name.
    Distinct names are searched, each once, however many athletes have it; % and _ in a term are characters like others.
    """
    known = people.join(recent.where(F.col("club_name").isNotNull()), "lifter_id")
    names = known.select("athlete_name").where(F.col("athlete_name").isNotNull()).distinct()
    # a term that is asked for again is searched for once: its first id stands for all
    every = terms.where(F.col("term").isNotNull()).select("term_id", "term")
    asked = every.groupBy("term").agg(F.min("term_id").alias("term_id")).select("term_id", "term")
    found = best_of(similar(materialise(names, "names"), materialise(asked, "terms")), top, asked.schema["term_id"].dataType.simpleString())
    hits = found.join(known, "athlete_name").unionByName(asked.join(known, F.col("term") == F.col("membership_number")).select("term_id", *known.columns), allowMissingColumns=True)
    first = known.where(F.col("athlete_name").isNotNull()).orderBy("athlete_name", "lifter_id").limit(top)
    hits = hits.unionByName(asked.where(F.col("term") == "").select("term_id", F.lit(1).alias("__1")).join(first.withColumn("__1", F.lit(1)), "__1").drop("__1"))
    hits = hits.dropDuplicates(["term_id", "lifter_id"]).join(asked, "term_id")
    rank = F.when(F.col("membership_number") == F.col("term"), 1).when(F.lower("athlete_name") == F.lower("term"), 2).otherwise(3)
    alike = F.coalesce(similarity("athlete_name", "term"), F.lit(0.0))
    place = F.row_number().over(Window.partitionBy("term_id").orderBy(rank, alike.desc(), "athlete_name", "lifter_id"))
    unknown = lambda c: F.coalesce(c, F.lit("Unknown")).alias(c)
    best = hits.withColumn("place", place).where(F.col("place") <= top).drop("term_id").join(every, "term")
    return best.select("term_id", "place", "lifter_id", "athlete_name", "membership_number", unknown("gender"), unknown("club_name"), unknown("wso"))
