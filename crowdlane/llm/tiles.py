"""Which members of each group of candidates really link, found in tiles.

A group may be large, so its members are never paired in one task, nor are all
pairs ever written: members are dealt to size bands and, in a band with many, to
about sqrt(count / 8) tiles by a hash. Each pair of tiles whose sizes allow a link is
one small group, which compares its members in place and gives back only as many
links as connect them. Every pair that could link meets in exactly one of these.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SMALL = 64
LINK = "a bigint, b bigint"
#: from the sizes and payloads of the members of two tiles
Test = Callable[[np.ndarray, list[bytes]], "Tester"]


class Tester:
    """may(i, js): which of js may link with i; links(i, j): whether i and j do."""

    def may(self, i: int, js: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def links(self, i: int, j: int) -> bool:
        raise NotImplementedError


class Joined:
    """Union of sets."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def band(n: str | Column, ratio: float) -> Column:
    """Sizes that link are at most ``ratio`` apart, so they are in one band or in neighbours."""
    # a little wider, so that rounding of the logarithm cannot put two bands between sizes that link
    return F.floor(F.log(F.col(n) if isinstance(n, str) else n) / float(np.log(ratio * 1.0001))).cast("int")


def verified_links(members: DataFrame, payloads: DataFrame, on: list[str], ratio: float, test: Test) -> DataFrame:
    """Links (a, b) between ``members`` (grp bigint, node bigint, n int > 0, and ``on``) of one group.

    They connect the same members as all pairs of a group for which ``test`` holds would.
    ``payloads`` has what is compared, by ``on``; it joins members that are dealt out already.
    """
    m = members.select("grp", "node", "n", *(c for c in on if c != "node"), band("n", ratio).alias("band"))
    count = m.groupBy("grp", "band").count()
    count = count.withColumn(
        "tiles", F.when(F.col("count") <= SMALL, 1).otherwise(F.ceil(F.sqrt(F.col("count") / 8))).cast("int")
    )
    # per group and band: its tiles, those of the band above and of the band below
    sides = (
        count.selectExpr("grp", "band", "count", "tiles own", "0 next", "0 before")
        .union(count.selectExpr("grp", "band - 1", "0", "0", "tiles", "0"))
        .union(count.selectExpr("grp", "band + 1", "0", "0", "0", "tiles"))
        .groupBy("grp", "band")
        .agg(*(F.max(c).alias(c) for c in ("count", "own", "next", "before")))
        .where("own > 0")
    )
    same = F.bitwise_not(F.bitwise_not("grp"))
    dealt = m.join(sides.select(same.alias("grp"), "band", "count", "own", "next", "before"), ["grp", "band"])
    dealt = dealt.withColumn("tile", F.expr("int(pmod(xxhash64(node, 7), own))"))
    pair = F.expr(
        """concat(
            transform(sequence(0, own - 1), x -> named_struct('lo', band, 'hi', band,
                'i', least(x, tile), 'j', greatest(x, tile), 'side', if(x < tile, 1, if(x = tile, 2, 0)))),
            if(next = 0, array(), transform(sequence(0, next - 1), x -> named_struct('lo', band, 'hi', band + 1,
                'i', tile, 'j', x, 'side', 0))),
            if(before = 0, array(), transform(sequence(0, before - 1), x -> named_struct('lo', band - 1, 'hi', band,
                'i', x, 'j', tile, 'side', 1))))"""
    )
    # a pair of tiles of two bands, or a tile with itself, is left out where nothing else is in it
    others = F.expr("if(p.side = 2, `count` > 1, true)")
    pieces = (
        dealt.withColumn("p", F.explode(pair))
        .where(others)
        .select("grp", "p.lo", "p.hi", "p.i", "p.j", "p.side", "n", *dict.fromkeys(["node", *on]))
        .join(payloads, on)
        .select("grp", "lo", "hi", "i", "j", "side", "node", "n", "payload")
    )

    def compare(table: pa.Table) -> pa.Table:
        node = table["node"].to_numpy()
        order = np.lexsort((node, table["n"].to_numpy()))
        table, node = table.take(pa.array(order)), node[order]
        side, size = table["side"].to_numpy(), table["n"].to_numpy()
        tester, joined, found = test(size, table["payload"].to_pylist()), Joined(len(node)), []
        one = bool((side == 2).any())  # a tile with itself
        for i in range(len(node)):
            # a pair is looked at once: from its smaller member
            js = np.arange(i + 1, len(node)) if one else np.flatnonzero(side[i + 1 :] != side[i]) + i + 1
            js = js[size[js] <= size[i] * ratio * 1.0001]
            if not len(js):
                continue
            for j in js[tester.may(i, js)].tolist():
                if joined.root(i) != joined.root(j) and tester.links(i, j):
                    joined.join(i, j)
                    found.append((node[i], node[j]))
        a, b = (np.array(x, np.int64) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
        return pa.table({"a": a, "b": b})

    return pieces.groupBy("grp", "lo", "hi", "i", "j").applyInArrow(compare, LINK)


class Jaccard(Tester):
    """Sets of 64-bit hashes, ascending, as bytes; they link when num * union <= den * intersection.

    A bitmap of hashed values bounds the intersection from above: each bit that only
    one set has stands for a value the other lacks. Pairs that the bound leaves are
    intersected exactly.
    """

    def __init__(self, size: np.ndarray, payload: list[bytes], num: int, den: int) -> None:
        self.size, self.num, self.den = size.astype(np.int64), num, den
        self.sets = [np.frombuffer(p, np.uint64) for p in payload]
        bits = 256
        while bits < min(4 * int(size.max()), 1 << 16):
            bits *= 2
        self.maps = np.zeros((len(size), bits // 64), np.uint64)
        for row, s in zip(self.maps, self.sets, strict=True):
            at = s & np.uint64(bits - 1)
            np.bitwise_or.at(row, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))

    def may(self, i: int, js: np.ndarray) -> np.ndarray:
        mine, out = self.maps[i], np.zeros(len(js), bool)
        for at in range(0, len(js), 256):
            part = js[at : at + 256]
            theirs = self.maps[part]
            lack = np.bitwise_count(mine & ~theirs).sum(1, dtype=np.int64)
            more = np.bitwise_count(theirs & ~mine).sum(1, dtype=np.int64)
            most = np.minimum(self.size[i] - lack, self.size[part] - more)
            out[at : at + 256] = self.enough(most, self.size[i] + self.size[part])
        return out

    def enough(self, both: np.ndarray, total: np.ndarray) -> np.ndarray:
        return self.den * both >= self.num * (total - both)

    def links(self, i: int, j: int) -> bool:
        x, y = self.sets[i], self.sets[j]
        at = np.searchsorted(y, x)
        at[at == len(y)] = 0
        return bool(self.enough(int((y[at] == x).sum()), len(x) + len(y)))
