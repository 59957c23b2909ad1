"""Operator 13: what quality filters remove, in every order, from decision diagrams.

A document's failures are a mask, one bit a filter. Masks are counted per
part of the corpus in Spark; for each part its counts (at most 2**filters of
them, whatever the corpus) make a decision diagram. A level tests one filter,
a node has a child for documents that pass and one for those that fail, equal
parts are shared, and every node carries the counts of the documents below
it. All orders of the filters come by swaps of two adjacent levels, which
rewrite those two levels alone. Along the path on which every filter passes,
a step's failing child is what that step removes and its passing child what
it keeps; the other figures follow from the steps of all orders.

Filter E (a copy) looks at the whole table: rows are grouped by the SHA-256
digest of their text, part and mask first, so the copies of a hot text are a
few rows a task before they are shuffled.

Defined results: null text is empty; a null part is the empty string; words
are case-sensitive; a null id has no labels, is no copy and makes no copy of
others; rows that repeat an id and text are both counted, neither being a
copy of the other; a document with several label rows is good (toxic) if one
says so; an empty input gives no rows; a part without documents can't occur.
Only the id, text and part columns are read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The filters, in the order of a mask's bits.
FILTERS = "ABCDE"
COUNTS = ("n", "good", "toxic")

_SPACES = " \t\n\x0b\f\r"


def failures(text: Column) -> Column:
    """Bits of the filters A to D that look at one text alone."""
    trimmed = F.btrim(text, F.lit(_SPACES))
    words = F.split(trimmed, "[\\x20\\x09-\\x0D]+")
    n = F.when(trimmed == "", 0).otherwise(F.size(words))
    distinct = F.when(trimmed == "", 0).otherwise(F.size(F.array_distinct(words)))
    size = F.length(text)
    capitals = size - F.length(F.translate(text, string.ascii_uppercase, ""))
    fails = [n < 200, 100 * distinct < 50 * n, 100 * capitals > 2 * size, text.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def _labelled(facts: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """``facts`` with good and toxic (0 or 1); rows without an id skip the join."""
    said = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = facts.where("id is not null").join(said, "id", "left")
    nameless = facts.where("id is null").withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    return known.unionByName(nameless).fillna(0, ["good", "toxic"])


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): how many documents of each part have each set of failures."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    facts = docs.select(docs[id_col].alias("id"), F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
                        F.unhex(F.sha2(text, 256)).alias("digest"), failures(text).alias("mask"))
    kind = ["digest", "part", "mask", "good", "toxic"]
    ids = _labelled(facts, labels, id_col).groupBy(*kind, "id").agg(F.count("*").alias("c"))
    kinds = ids.groupBy(*kind).agg(
        F.sum("c").alias("n"), F.min("id").alias("first"), F.min_by("c", "id").alias("at_first"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("c"))), F.lit(0)).alias("nameless"))
    least = kinds.groupBy("digest").agg(F.min("first").alias("least"))
    copy = F.lit(1 << FILTERS.index("E"))
    original = F.col("nameless") + F.when(F.col("first") == F.col("least"), F.col("at_first")).otherwise(0)
    both = F.explode(F.array(F.struct(F.col("mask").alias("mask"), original.alias("n")),
                             F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - original).alias("n"))))
    split = kinds.join(least, "digest").select("part", "good", "toxic", both.alias("x")).select("part", "good", "toxic", "x.*")
    return split.where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


class Diagram:
    """Counts by failure mask, as levels of shared nodes.

    ``levels[i]`` maps a node's number to its (passing, failing) child; below
    the last level stand the distinct counts. ``weight`` is what lies below.
    """

    def __init__(self, filters: str, counts: dict[int, tuple[int, ...]]):
        self.order = list(filters)
        self.weight: list[tuple[int, ...]] = []
        self.levels: list[dict[int, tuple[int, int]]] = [{} for _ in filters]
        leaves: dict[tuple[int, ...], int] = {}
        none = (0,) * len(COUNTS)

        def leaf(mask: int) -> int:
            held = counts.get(mask, none)
            if held not in leaves:
                leaves[held] = self._number(held)
            return leaves[held]

        known: list[dict[tuple[int, int], int]] = [{} for _ in filters]

        def below(level: int, mask: int) -> int:
            if level == len(filters):
                return leaf(mask)
            return self._node(level, below(level + 1, mask), below(level + 1, mask | 1 << level), known[level])

        self.root = below(0, 0)

    def _number(self, weight: tuple[int, ...]) -> int:
        self.weight.append(weight)
        return len(self.weight) - 1

    def _node(self, level: int, passing: int, failing: int, known: dict[tuple[int, int], int]) -> int:
        """The level's node with these children; a new one only where there is none."""
        pair = (passing, failing)
        if pair not in known:
            known[pair] = self._number(tuple(a + b for a, b in zip(self.weight[passing], self.weight[failing])))
            self.levels[level][known[pair]] = pair
        return known[pair]

    def swap(self, level: int) -> None:
        """Exchange the filters of a level and the next. Nodes of the upper level
        keep their numbers, so nothing above or below changes."""
        upper, lower = self.levels[level], self.levels[level + 1]
        self.levels[level + 1], known = {}, {}
        for node, (passing, failing) in upper.items():
            (pp, pf), (fp, ff) = lower[passing], lower[failing]
            upper[node] = (self._node(level + 1, pp, fp, known), self._node(level + 1, pf, ff, known))
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[str, tuple[int, ...], tuple[int, ...]]]:
        """(filter, kept, removed) along the path on which all pass."""
        node = self.root
        for level, name in enumerate(self.order):
            node, failing = self.levels[level][node]
            yield name, self.weight[node], self.weight[failing]


def adjacent_swaps(n: int) -> Iterator[int]:
    """Places of the swaps that lead through all orders of n things, each once:
    the last walks from end to end between two moves of the others."""
    if n < 2:
        return
    back = True
    for move in [*adjacent_swaps(n - 1), None]:
        yield from (range(n - 2, -1, -1) if back else range(n - 1))
        if move is not None:
            yield move + 1 if back else move
        back = not back


def audit_part(counts: dict[int, tuple[int, ...]], filters: str = FILTERS) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every order."""
    diagram = Diagram(filters, counts)
    found = [("".join(diagram.order), list(diagram.steps()))]
    for place in adjacent_swaps(len(filters)):
        diagram.swap(place)
        found.append(("".join(diagram.order), list(diagram.steps())))
    failing, alone, whole = {}, {}, dict.fromkeys(filters, 0)
    for _, steps in found:
        failing[steps[0][0]] = steps[0][2][0]  # first: removes all that fail it
        alone[steps[-1][0]] = steps[-1][2][0]  # last: what fails nothing else
        for name, _, removed in steps:
            whole[name] += removed[0]
    return [(order, at, kept[0], removed[0], failing[name] - removed[0], alone[name], removed[1], removed[2], whole[name])
            for order, steps in found for at, (name, kept, removed) in enumerate(steps, 1)]


def audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """All orders' steps of every part of ``mask_counts``. A group is one part's masks."""
    names = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def run(part: pd.DataFrame) -> pd.DataFrame:
        counts = {int(m): (int(n), int(g), int(t)) for m, n, g, t in zip(part["mask"], part["n"], part["good"], part["toxic"])}
        out = pd.DataFrame(audit_part(counts, filters), columns=names)
        out.insert(0, "part", part["part"].iloc[0])
        return out

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in names[2:])
    return masks.groupBy("part").applyInPandas(run, schema)
