"""Language identification by cross-parsing against suffix automata of labelled text.

For each language the excerpts of its labelled documents become one suffix automaton.  A
text is cut into phrases from left to right: a phrase goes on as long as the automaton
knows it as a substring of the labelled text.  A language that fits gives long matches and thus few
phrases.  A phrase stands for a pointer into the labelled text, log2 of its length in bits; the
language with the fewest bits per symbol wins.

Texts are parsed in lower case, with every run of other characters than letters as one
blank, in pieces of ``PIECE`` symbols that are parsed side by side.  A piece begins a new
phrase in every language alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordweave.llm.common import materialize, ship_package, slices, without

#: Bounds of the labelled sample: symbols of all languages together, symbols of one at most, and excerpts of one.
SAMPLE_SYMBOLS = 1 << 19
LANGUAGE_SYMBOLS = 1 << 15
LANGUAGE_EXCERPTS = 64
#: Symbols a language gets at least: with more languages than the sample has room for, the sample grows with them.
LEAST_SYMBOLS = 64
PIECE = 512
UNDETERMINED = "und"
#: A text of at least ``MIN_SYMBOLS`` that costs more bits per symbol than the limit of its best language is no text of any of them.
#: The limit is ``MAX_BITS``, or what ``LIMIT_PART`` of such pieces of the language's own labelled texts cost if that is more.
MIN_SYMBOLS, MAX_BITS, LIMIT_PART = 64, 5.0, 0.99
#: Most letters with a column in the table of transitions; those of other letters are searched for.
COLUMNS = 254


@dataclass(frozen=True)
class Sample:
    """What is learned: the names of the languages, a text for each, in the order of the names, and limits in bits per symbol."""

    names: tuple[str, ...]
    texts: tuple[str, ...]
    limits: tuple[float, ...] = ()


def learn(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Sample:
    """Collect the bounded sample from the rows of ``docs`` where ``usable`` holds.

    Every value of ``lang`` is learned.  They share the symbols evenly, down to ``LEAST_SYMBOLS`` each.  Every
    language gives at most ``LANGUAGE_EXCERPTS`` excerpts from the middle of distinct texts, those
    with the lowest text hash, so that neither copies nor file order matter.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.where(usable & F.col(f"`{lang_col}`").isNotNull() & text.rlike(r"\p{L}")).select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.xxhash64(text).alias("hash"), text.alias("text")
    )
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("hash").alias("texts"))
    every = sizes.collect()
    names = sorted(r.lang for r in every)
    if not names:
        return Sample((), ())
    share = max(LEAST_SYMBOLS, min(LANGUAGE_SYMBOLS, SAMPLE_SYMBOLS // len(names)))
    width = max(32, share // LANGUAGE_EXCERPTS)
    # short texts fill less than their excerpt, so more of them are fetched than a full share takes
    fetched = 4 * LANGUAGE_EXCERPTS
    middle = F.greatest(F.lit(1), F.floor((F.length("text") - F.lit(width)) / 2).cast("int"))
    # only hashes below a bound that some thousand distinct texts of a language are under get as far as the shuffle
    bound = F.create_map(*[
        x for r in every for x in (F.lit(r.lang), F.lit(min((1 << 63) - 1, int((1 << 63) * 16 * fetched / max(1, r.texts)))))
    ])
    low = F.shiftrightunsigned("hash", 1) <= bound[F.col("lang")]
    cut = rows.where(low).select("lang", "hash", F.substring("text", middle, F.lit(width)).alias("text"))
    # copies have one hash and count once
    first = cut.groupBy("lang", "hash").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.shiftrightunsigned("hash", 1), "hash"))
    chosen = first.withColumn("rank", rank).where(F.col("rank") <= fetched).orderBy("lang", "rank").collect()
    texts, outside = {n: "" for n in names}, {n: [] for n in names}
    for row in chosen:
        if len(texts[row.lang]) < share:
            texts[row.lang] += " " + row.text
        elif len(outside[row.lang]) < LANGUAGE_EXCERPTS:
            outside[row.lang].append(row.text)
    learned = [texts[n][:share] for n in names]
    return Sample(tuple(names), tuple(learned), tuple(_limit(t, outside[n]) for n, t in zip(names, learned, strict=True)))


def _limit(text: str, outside: list[str]) -> float:
    """The limit of a language, from labelled texts outside its sample; without any, one half of the sample is parsed by the other."""
    if not outside:
        text, outside = text[: len(text) // 2], [text[len(text) // 2 :]]
    pieces = [p for t in outside for i in range(0, len(t), MIN_SYMBOLS) if len(p := t[i : i + MIN_SYMBOLS]) == MIN_SYMBOLS]
    if not pieces:
        return MAX_BITS
    model = Model(Sample(("",), (text,)))
    total, sizes, letters = model.phrases(pieces)
    cost = (total[:, 0] * model.bits[0] / np.maximum(1, sizes))[letters > 0]
    return max(MAX_BITS, float(np.quantile(cost, LIMIT_PART, method="higher"))) if len(cost) else MAX_BITS


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings, state 0 first (Blumer's online construction)."""
    moves, link, length = [{}], [-1], [0]
    last = 0
    for c in symbols:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[new] = clone
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
        last = new
    return moves


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point: 1 for a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.uint8, 0x110000)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _squeeze(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Drop blanks (0) that follow a blank or begin a text; also the lengths of the texts after that."""
    blank = symbols == 0
    before = np.empty_like(blank)
    before[:1] = True
    before[1:] = blank[:-1]
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[lengths > 0]
    before[starts] = True
    keep = ~(blank & before)
    count = np.concatenate([[0], np.cumsum(keep)])
    return symbols[keep], count[ends] - count[ends - lengths]


class Model:
    """Automata of all languages in one table: row of a state, column of a symbol, next row and whether a phrase ended.

    The most frequent letters have a column.  Transitions by other letters stand in a sorted list; the column after the letters
    holds what a letter that no sample has does.
    """

    def __init__(self, sample: Sample) -> None:
        self.names = sample.names
        self.limits = np.array(sample.limits or [MAX_BITS] * len(sample.names))
        lowered = [t.lower() for t in sample.texts]
        points = _points("".join(lowered))
        known, times = np.unique(points[_letters()[points] == 1], return_counts=True)
        known = known[np.lexsort((known, -times))]
        self.other = min(COLUMNS, len(known)) + 1
        self.rare = max(0, len(known) - COLUMNS)
        self.code = np.where(_letters() == 1, self.other, 0).astype(np.int32)
        self.code[known[:COLUMNS]] = np.arange(1, self.other)
        self.code[known[COLUMNS:]] = np.arange(self.other + 1, self.other + 1 + self.rare)
        self.width = self.other + 1
        tables, self.root, self.bits, rows = [], [], [], 0
        keys, targets = [], []
        for text in lowered:
            raw = self.code[_points(text)]
            symbols, _ = _squeeze(raw, np.array([len(raw)]))
            moves = suffix_automaton(symbols.tolist())
            start = np.full(self.width, rows * self.width * 2 + 1, np.int32)
            for c, to in moves[0].items():
                if c < self.width:
                    start[c] = (rows + to) * self.width * 2 + 1
            table = np.tile(start, (len(moves), 1))
            for state, to in enumerate(moves):
                for c in [c for c in to if c > self.other] if self.rare else []:
                    keys.append((rows + state) * self.rare + c - self.width)
                    targets.append((rows + to.pop(c)) * self.width * 2)
                if to:
                    table[state, list(to)] = (rows + np.fromiter(to.values(), np.int64)) * self.width * 2
            tables.append(table)
            self.root.append(rows * self.width * 2)
            self.bits.append(np.log2(len(symbols) + 2))
            rows += len(moves)
        self.table = np.concatenate(tables).ravel() if tables else np.empty(0, np.int32)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.targets = np.append(np.array(targets, np.int32)[order], np.int32(0))

    def _searched(self, states: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """As the table: the next row and whether a phrase ended, by language and piece, for letters without a column."""
        roots = np.array(self.root, np.int32)[:, None]
        rare = (letters - self.width).astype(np.int64)

        def look(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            wanted = at // self.width * np.int64(self.rare) + rare
            place = np.searchsorted(self.keys, wanted)
            return self.keys[place] == wanted, self.targets[place]

        there, to = look(states)
        first, begin = look(np.broadcast_to(roots >> 1, states.shape))
        return np.where(there, to, np.where(first, begin, roots) + 1)

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: phrases by language, symbols, letters."""
        lowered = [t.lower() for t in texts]
        points = _points("".join(lowered))
        lengths = np.fromiter(map(len, lowered), np.int64, len(lowered))
        raw = self.code[points]
        symbols, sizes = _squeeze(raw, lengths)
        searched = self.rare > 0 and bool((symbols > self.other).any())
        columns = np.minimum(symbols, self.other) if searched else symbols
        count = np.concatenate([[0], np.cumsum(symbols != 0)])
        ends = np.cumsum(sizes)
        letters = count[ends] - count[ends - sizes]
        pieces = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(texts)), pieces)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = (ends - sizes)[owner] + place * PIECE
        size = np.minimum(PIECE, ends[owner] - start)
        order = np.argsort(-size, kind="stable")
        start, size, owner = start[order], size[order], owner[order]
        state = np.repeat(np.array(self.root, np.int32)[:, None] >> 1, len(start), axis=1)
        broken = np.ones((len(self.names), len(start)), np.int32)
        active = np.searchsorted(-size, -np.arange(PIECE), side="left")  # pieces longer than each step
        for step in range(PIECE):
            k = active[step]
            if not k:
                break
            found = self.table[state[:, :k] + columns[start[:k] + step]]
            if searched:
                here = symbols[start[:k] + step]
                some = np.flatnonzero(here > self.other)
                if len(some):
                    found[:, some] = self._searched(state[:, some], here[some])
            broken[:, :k] += found & 1
            state[:, :k] = found >> 1
        total = np.zeros((len(texts), len(self.names)), np.int64)
        np.add.at(total, owner, broken.T)
        return total, sizes, letters


@lru_cache(maxsize=1)
def model_of(sample: Sample) -> Model:
    """The model, built once in a worker."""
    return Model(sample)


def predict(model: Model, texts: list[str]) -> tuple[list[str], list[float], list[float], list[bool]]:
    """Language, score, bits per symbol and whether it is rejected, of each text."""
    if not model.names:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts), [0.0] * len(texts), [True] * len(texts)
    total, sizes, letters = model.phrases(texts)
    cost = total * np.array(model.bits) / np.maximum(1, sizes)[:, None]
    best = cost.argmin(axis=1)
    least = cost[np.arange(len(texts)), best]
    rest = cost.copy()
    rest[np.arange(len(texts)), best] = np.inf
    second = rest.min(axis=1) if len(model.names) > 1 else np.full(len(texts), np.inf)
    score = np.clip(1 - least / np.where(second > 0, second, 1), 0, 1)
    found = letters > 0
    names = [model.names[i] if f else UNDETERMINED for i, f in zip(best, found, strict=True)]
    strange = ~found | ((sizes >= MIN_SYMBOLS) & (least > model.limits[best]))
    return names, np.where(found, score, 0.0).tolist(), np.where(found, least, 0.0).tolist(), strange.tolist()


def identify(docs: DataFrame, sample: Sample, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (0 to 1), ``bits`` per symbol and ``rejected`` for every row of ``docs``.

    Null and empty texts and texts without letters are ``und`` with score 0 and bits 0.  On a tie
    the first language by name wins with score 0.  Without labelled rows everything is ``und``.
    Rejected are ``und`` rows and those of ``MIN_SYMBOLS`` or more above the limit of the language predicted.  Rows with a null id and repeated rows are
    answered like any other; other columns are not read.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(sample)
        for batch in slices(batches, "text"):
            names, score, bits, rejected = predict(model, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("hash"), pa.array(names, pa.string()), pa.array(score, pa.float64()),
                 pa.array(bits, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "text_hash", "lang_pred", "score", "bits", "rejected"],
            )

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    chosen = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    return chosen.mapInArrow(run, "doc_id bigint, text_hash bigint, lang_pred string, score double, bits double, rejected boolean")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the id as text, modulo 4, is 2.  A null id counts as empty text."""
    text = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2


def keep_identified(docs: DataFrame, sample: Sample, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is in one of the languages, all columns kept, the text compared by id and hash."""
    gone = materialize(
        identify(docs, sample, id_col, text_col).where("rejected").select("doc_id", "text_hash").distinct(),
        "rejected",
    )
    return without(docs, gone, id_col, text_col)
