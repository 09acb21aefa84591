"""Fill-in-the-middle: texts cut in three and put together in another order."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of one block of a text.
BLOCK = 1 << 12
SENTINELS = ("<P>", "<S>", "<M>")
RATE, SPM_RATE, SEED = 90, 20, 1

RESULT = "form string, n long, prefix_chars long, middle_chars long, output string"


class Blocks:
    """A Fenwick tree over the blocks of one UTF-8 text: the units and the code points
    that begin in each. Units are code points, or the matches of a pattern from left to
    right; what lies before, between and after matches belongs to the unit before it (to the
    first one at the beginning of the text)."""

    def __init__(self, text: bytes, unit: str | None = None, block: int = BLOCK) -> None:
        self.raw, self.block = np.frombuffer(text, np.uint8), block
        points = (self.raw & 0xC0) != 0x80
        self.starts = points
        if unit is not None:
            at = np.fromiter((m.start() for m in re.finditer(unit, text.decode())), np.int64)
            if len(at):
                at[0] = 0
            self.starts = np.zeros(len(self.raw), bool)
            self.starts[np.flatnonzero(points)[np.unique(at[at < points.sum()])]] = True
        self.points = points
        edges = np.arange(0, len(self.raw), block)
        counts = np.zeros((len(edges) + 1, 2), np.int64)
        if len(edges):
            counts[1:, 0] = np.add.reduceat(self.starts, edges, dtype=np.int64)
            counts[1:, 1] = np.add.reduceat(points, edges, dtype=np.int64)
        sums = counts.cumsum(axis=0)
        index = np.arange(len(sums))
        self.tree = sums - sums[index & (index - 1)] if len(edges) else sums
        self.units, self.chars = (int(x) for x in sums[-1])

    def place(self, unit: int) -> tuple[int, int]:
        """(byte, code point) at which a unit begins; the end of the text for one more than there are."""
        if unit >= self.units:
            return len(self.raw), self.chars
        at, step = 0, 1 << (len(self.tree) - 1).bit_length()
        left, points = unit, 0
        while step:
            if at + step < len(self.tree) and self.tree[at + step, 0] <= left:
                at += step
                left -= int(self.tree[at, 0])
                points += int(self.tree[at, 1])
            step >>= 1
        start = at * self.block
        inside = int(np.flatnonzero(self.starts[start : start + self.block])[left])
        return start + inside, points + int(self.points[start : start + inside].sum())


def check_sentinels(sentinels: Sequence[str]) -> None:
    """Sentinels must be found again in an output: none may overlap another or itself."""
    if len(sentinels) != 3 or len(set(sentinels)) != 3 or not all(sentinels):
        raise ValueError("three different sentinels are needed")
    for a in sentinels:
        for b in sentinels:
            if (a != b and a in b) or any(a.endswith(b[:i]) for i in range(1, min(len(a), len(b)))):
                raise ValueError(f"the sentinels {a} and {b} may overlap")


def arrange(text: bytes, digest: str, sentinels: Sequence[bytes], unit: str | None, rate: int, spm_rate: int) -> tuple:
    """(form, n, prefix_chars, middle_chars, output) of one text, by draws from its digest."""
    blocks = Blocks(text, unit)
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(s in text for s in sentinels) or h3 % 100 >= rate:
        return "plain", blocks.units, None, None, text
    first, second = sorted((h1 % (blocks.units + 1), h2 % (blocks.units + 1)))
    (a, chars_a), (b, chars_b) = blocks.place(first), blocks.place(second)
    p, s, m = sentinels
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_rate:
        form, output = "spm", b"".join((s, suffix, p, prefix, m, middle))
    else:
        form, output = "psm", b"".join((p, prefix, s, suffix, m, middle))
    return form, blocks.units, chars_a, chars_b - chars_a, output


def middle(
    text: Column,
    key: Column,
    sentinels: Sequence[str] = SENTINELS,
    unit: str | None = None,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
    seed: int = SEED,
) -> Column:
    """A struct (form, n, prefix_chars, middle_chars, output) of a text.

    Two cuts among its n units, the form and its order are drawn from the SHA-256 of
    ``seed:key``, so a row has the same result wherever and however often it is
    computed. psm is prefix, suffix, middle, spm suffix, prefix, middle, each after its
    sentinel. A text that is empty or holds a sentinel is plain, and so are 100 - ``rate``
    in a hundred of the others; a plain one is its own output, without lengths. A null text
    is empty, a null key the empty string; equal keys have equal draws.
    """
    check_sentinels(sentinels)
    marks = [s.encode() for s in sentinels]
    kind = pa.struct([("form", pa.string()), ("n", pa.int64()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

    @F.arrow_udf(RESULT)
    def arranged(texts: pa.Array, digests: pa.Array) -> pa.Array:
        rows = [arrange(t, d, marks, unit, rate, spm_rate) for t, d in zip(texts.cast(pa.binary()).to_pylist(), digests.to_pylist())]
        columns = list(zip(*rows)) or [[]] * 5
        output = pa.array(columns[4], pa.binary()).cast(pa.string())
        return pa.StructArray.from_arrays([*(pa.array(c, f.type) for c, f in zip(columns[:4], kind)), output], fields=list(kind))

    draws = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return arranged(F.coalesce(text, F.lit("")), draws)


def restored(output: Column, form: Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text from an output and its form."""
    parts = F.split(output, "|".join(rf"\Q{s}\E" for s in sentinels), -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def with_middle(docs: DataFrame, output: str = "fim", text: str = "text", key: str = "doc_id", **params: object) -> DataFrame:
    """``docs`` with the struct of ``middle`` as column ``output``, which replaces one of that name."""
    return docs.withColumn(output, middle(F.col(text), F.col(key), **params))
