"""Phrase collocations by stripes.

Every prefix of up to four words keys a stripe: an associative counter of the words that follow it.  Chunks of texts count their
stripes on their own, stripes of the same prefix are merged element by element, and everything asked for is read from them:

* extensions: an element is the count of the prefix with that word behind it;
* prefix totals: a prefix has its own count as an element in the stripe of its shorter prefix; the stripe of the empty prefix, in which one
  element stands for all rare words, adds up to the number of words;
* subsumption maxima: the largest element of a stripe, and the largest element that ends a phrase with a word in front, tell
  whether a longer phrase occurs as often.  Counts never grow with length, so phrases one word longer decide.

A phrase that occurs ``least`` times holds only phrases that do.  So chunks first ask (``chunks``) which of their words, pairs and,
where both pairs are frequent, triples are frequent everywhere, and keep elements of their stripes only for phrases made of
those.  That only leaves out phrases below ``least``.  The elements go out packed, one list for each bucket of the hash
space, where they are added up; so the stripe of a frequent word is spread over all buckets and never held whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordweave.llm import chunks as ch
from recordweave.llm.common import materialize, ship_package
from recordweave.operators.lookup import broadcast_if_small

LEAST, WORDS, TOP = 100, 5, 2000
#: Texts without a language.
NO_LANGUAGE = "und"
#: Longest phrases that chunks ask about.
ASKED = 3
#: Parts of a language's phrases that are ranked before its best are.
RANK_PARTS = 64
#: What stands between pieces; all of these become a full stop, which is a word of its own and no part of any other.
SEPARATORS = bytes(b"."[0] if chr(c) in ".,;:!?\n\x0b\x0c\r" else c for c in range(256))
_STOP = b"."

#: Fewer buckets than for hashes, as a logarithm: only frequent phrases are merged.
FEWER_BITS = 3

STRIPES = "bucket bigint, lang string, prefixes array<string>, words array<string>, times array<bigint>"
ELEMENTS = "lang string, prefix string, word string, times bigint"


class _Sequence:
    """The words of one language in a chunk, as numbers end to end with stops between pieces and texts."""

    def __init__(self, lang: str, texts: list[bytes | None]) -> None:
        words = [(t or b"").lower().translate(SEPARATORS).replace(_STOP, b" . ").split() for t in texts]
        self.lang = lang
        self.numbers, self.names, _ = ch.numbered([part for w in words for part in (w, [_STOP])])
        seed = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
        self.hashes = ch.mixed(ch.word_hashes(self.names) ^ seed)[self.numbers]
        stops = np.flatnonzero(self.numbers == self.names.index(_STOP))
        place = np.arange(len(self.numbers))
        self.text = pa.array(self.names, pa.binary()).cast(pa.string())
        #: Words from each place to the end of its piece.
        self.room = stops[np.searchsorted(stops, place)] - place

    def grams(self, size: int, at: np.ndarray) -> np.ndarray:
        """Hashes of the phrases of ``size`` words at some places."""
        out = np.zeros(len(self.numbers), np.uint64)
        found = ch.gram_hashes(self.hashes, size)
        out[: len(found)] = found
        return out[at]

    def whole(self, size: int) -> np.ndarray:
        """Whether a phrase of ``size`` words starts at each place."""
        return self.room >= size

    def phrases(self, size: int, at: np.ndarray) -> pa.Array:
        """The phrases of ``size`` words at some places, as text."""
        if not size:
            return pa.array([""] * len(at), pa.string())
        return pc.binary_join_element_wise(*[self.text.take(pa.array(self.numbers[at + k])) for k in range(size)], " ")

    def frequent(self, told: ch.Totals, most: int, least: int) -> list[np.ndarray]:
        """Whether the phrase of 1, 2, ..., ``most`` words at each place may occur ``least`` times, as far as was told for up to ``ASKED`` words."""
        out = [np.ones(len(self.numbers), bool)]
        for size in range(1, most + 1):
            ahead = np.r_[out[-1][1:], False] if size > 1 else out[-1]
            may = out[-1] & ahead & self.whole(size)
            if size <= ASKED:
                at = np.flatnonzero(may)
                may[at] = told.of(self.grams(size, at)) >= least
            out.append(may)
        return out


def _sequences(rows: pa.Table) -> Iterator[_Sequence]:
    langs = rows.column("lang").to_pylist()
    texts = rows.column("text").to_pylist()
    for lang in sorted(set(langs)):
        yield _Sequence(lang, [t for own, t in zip(langs, texts, strict=True) if own == lang])


def _ask_first(rows: pa.Table, chunk: int, bits: int) -> pa.Table:
    """Requests for the words and pairs of a chunk."""
    asked = [s.grams(size, np.flatnonzero(s.whole(size))) for s in _sequences(rows) for size in (1, 2)]
    return ch.request(chunk, *ch.counted(np.concatenate([np.empty(0, np.uint64), *asked])), bits)


def _ask_more(rows: pa.Table, chunk: int, told: ch.Totals, size: int, bits: int, least: int) -> pa.Table:
    """Requests for the phrases of ``size`` words whose two shorter parts are frequent."""
    asked = [np.empty(0, np.uint64)]
    for s in _sequences(rows):
        part = s.frequent(told, size - 1, least)[-1]
        at = np.flatnonzero(part & np.r_[part[1:], False] & s.whole(size))
        asked.append(s.grams(size, at))
    return ch.request(chunk, *ch.counted(np.concatenate(asked)), bits)


def _counted_stripes(rows: pa.Table, chunk: int, told: ch.Totals, most: int, bits: int, least: int) -> pa.Table:
    """The elements of a chunk's stripes, in one list for each bucket.  The empty word stands for all rare words."""
    names = ["bucket", "lang", "prefixes", "words", "times"]
    kinds = [pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64())]
    out = [pa.schema(list(zip(names, kinds, strict=True))).empty_table()]
    for s in _sequences(rows):
        for size, may in enumerate(s.frequent(told, most, least)[1:]):
            at = np.flatnonzero(may)
            cells, first, times = np.unique(s.grams(size + 1, at), return_index=True, return_counts=True)
            bucket = (cells >> np.uint64(64 - bits) if bits else np.zeros(len(cells), np.uint64)).astype(np.int64)
            cuts = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)] if len(bucket) else np.zeros(1, np.int64)
            ends = pa.array(cuts, pa.int32())
            place = at[first]
            lists = [s.phrases(size, place), s.text.take(pa.array(s.numbers[place + size])), pa.array(times, pa.int64())]
            columns = [pa.array(bucket[cuts[:-1]]), pa.array([s.lang] * (len(cuts) - 1), pa.string())]
            columns += [pa.ListArray.from_arrays(ends, part) for part in lists]
            out.append(pa.Table.from_arrays(columns, names))
            if not size:
                rest = int(s.whole(1).sum()) - len(at)
                out.append(pa.Table.from_arrays([pa.array([c], k) for c, k in zip([0, s.lang, [""], [""], [rest]], kinds, strict=True)], names))
            if not len(at):
                break
    return pa.concat_tables([table.cast(out[0].schema) for table in out])


def _added_up(table: pa.Table) -> pa.Table:
    """The elements of a bucket, with the counts of all chunks."""
    lists = [table.column(c).combine_chunks() for c in ("prefixes", "words", "times")]
    owner = pc.list_parent_indices(lists[0])
    flat = [table.column("lang").combine_chunks().take(owner), *[part.flatten() for part in lists]]
    names = ["lang", "prefix", "word", "times"]
    summed = pa.Table.from_arrays(flat, names).group_by(names[:3]).aggregate([("times", "sum")])
    return summed.select(["lang", "prefix", "word", "times_sum"]).rename_columns(names)


def stripe_elements(docs: DataFrame, text_col: str, lang_col: str, least: int, most: int) -> DataFrame:
    """``lang``, ``prefix``, ``word``, ``times``: the merged stripes, one row for an element, as a table."""
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANGUAGE))
    chunks = ch.chunked(docs.select(lang.alias("lang"), F.col(f"`{text_col}`").cast("binary").alias("text")), "text", "collocation-chunks")
    bits = ch.bucket_bits(chunks, 2)
    replies = materialize(ch.tally(ch.each_chunk(chunks, partial(_ask_first, bits=bits), ch.REQUESTS), least), "collocation-replies")
    for size in range(3, min(ASKED, most) + 1):
        more = ch.with_totals(chunks, replies, bits, partial(_ask_more, size=size, bits=bits, least=least), ch.REQUESTS)
        replies = replies.unionByName(materialize(ch.tally(more, least), "collocation-replies"))
    merge = max(0, bits - FEWER_BITS)
    stripes = ch.with_totals(chunks, replies, bits, partial(_counted_stripes, most=most, bits=merge, least=least), STRIPES)

    def add_up(bucket: pa.Table) -> pa.Table:
        return _added_up(bucket)

    return materialize(stripes.groupBy("bucket").applyInArrow(add_up, ELEMENTS), "collocation-stripes")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, most: int = WORDS, top: int = TOP
) -> DataFrame:
    """The ``top`` phrases of every language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``, ``cut``.

    Texts are lower-cased (A to Z), cut into pieces at punctuation and line ends and those into words at blanks.  Phrases have 2 to
    ``most`` words and occur ``least`` times or more, overlaps included.  A phrase cut after ``k`` words has the score
    floor(1000 a n / (l r)) of its parts' counts; the lowest counts, of equal ones that of the smallest ``k``.  Phrases inside a longer
    one that occurs as often are dropped.  Products are decimals of 38 digits.

    Null texts are empty, a null language is ``und``.  Repeated rows count as often as they come.  Empty tables, and languages without frequent phrases,
    give no rows.  Ties are ordered by the phrase's bytes.  Other columns are not touched.
    """
    if most < 2:
        raise ValueError("phrases have two words at least")
    ship_package(docs.sparkSession)
    elements = stripe_elements(docs, text_col, lang_col, least, most)
    spoken = elements.where("prefix = ''").groupBy("lang").agg(F.sum("times").alias("n"))
    named = elements.where((F.col("word") != "") & (F.col("times") >= least))
    totals = named.select(
        "lang", F.when(F.col("prefix") == "", F.col("word")).otherwise(F.concat_ws(" ", "prefix", "word")).alias("phrase"), F.col("times").alias("total")
    )
    phrases = totals.where(F.instr("phrase", " ") > 0).select("lang", "phrase", F.col("total").alias("a"), F.split("phrase", " ", -1).alias("w"))
    behind = lambda k: F.array_join(F.slice("w", k + 1, F.size("w")), " ")
    longer = phrases.where(F.size("w") > 2).groupBy("lang", behind(F.lit(1)).alias("phrase")).agg(F.max("a").alias("before"))
    after = named.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.max("times").alias("widest"))
    kept = phrases.join(longer, ["lang", "phrase"], "left").join(after, ["lang", "phrase"], "left").where(
        F.coalesce(F.greatest("before", "widest"), F.lit(0)) < F.col("a")
    )
    cuts = kept.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("head"), behind(F.col("cut")).alias("tail")
    )
    part = lambda name, count: totals.select("lang", F.col("phrase").alias(name), F.col("total").alias(count))
    scored = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"]).join(broadcast_if_small(spoken), "lang")
    whole = lambda name: f"cast({name} as decimal(19, 0))"
    score = F.expr(f"(1000 * {whole('a')} * {whole('n')}) div ({whole('l')} * {whole('r')})")
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    best = best.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score", "best.cut")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each part first, so that a language's phrases are not ranked by one task.
    parted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*order)
    first = best.withColumn("place", F.row_number().over(parted)).where(F.col("place") <= top).drop("place")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score", F.col("cut").cast("bigint").alias("cut"))
