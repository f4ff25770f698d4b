"""Quality rules by distribution divergence (operator 4).

Method. A text has a histogram of character classes and one of the common words of its
language. The references of a language are the mean histograms of its documents that
pass the base rules, taken over all documents; its common words are those that make up
at least ``least_share`` of its words. A text is rejected if, by Jensen-Shannon distance
(base 2, 0 to 1), it is far from the references of its language. The limits grow for short
texts, whose histograms are uneven by chance, and below a least length a histogram
isn't judged.

Common words. Each task keeps a Misra-Gries summary a language: at most ``4 / least_share``
words with counts, and how much was taken off all of them. Summaries are merged in a tree of
small groups into one a language. It has each word with ``least_share`` of the language, and
at most ``4 / (3 * least_share)`` words come into question, whatever the number of tasks.
These are counted exactly over all documents.

Languages. One with ``ENOUGH_DOCUMENTS`` passing documents has references, however large the
others are. For texts of any other language, or of none, there is no reference: the base rules
alone decide, and both distances are null.

Defined cases. Null text has no words; it fails the base rules. Rows that repeat an id are judged
each. Extra columns are ignored. What the driver holds grows with the languages that
documents name, by some hundreds of words each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import Steps, chunks, import_on_executors, per_text, words_of
from lakemart.llm.ngram_jaccard import mixed

LEAST_SHARE = 0.004
#: A language needs so many passing documents for references.
ENOUGH_DOCUMENTS = 30
#: (limit for long texts, its growth with 1 / sqrt(length), least length)
CLASS_LIMIT = (0.27, 0.9, 100)
WORD_LIMIT = (0.38, 0.5, 20)
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
#: Summaries that are merged at a time.
FAN_IN = 32
#: Shares are added up as whole numbers of this unit, so that sums don't depend on their order.
UNIT = 1 << 30

CLASSES = ["lower", "upper", "digit", "space", "punctuation", "symbol", "other", "beyond_ascii"]
_INSIDE = len(CLASSES)  # a byte that continues a character


def _class_of_byte() -> np.ndarray:
    table = np.full(256, CLASSES.index("other"))
    for code in range(128):
        char = chr(code)
        if char in SYMBOLS:
            table[code] = CLASSES.index("symbol")
        elif char in " \t\n\x0b\x0c\r":
            table[code] = CLASSES.index("space")
        elif char.isalpha():
            table[code] = CLASSES.index("lower" if char.islower() else "upper")
        elif char.isdigit():
            table[code] = CLASSES.index("digit")
        elif char in ".,;:!?'\"()-":
            table[code] = CLASSES.index("punctuation")
    table[0x80:0xC0] = _INSIDE
    table[0xC0:] = CLASSES.index("beyond_ascii")
    return table


_BYTES = _class_of_byte()


def class_counts(text: pa.Array) -> np.ndarray:
    """Characters of each class, per text."""
    text = text.take(pa.array(np.arange(len(text)))).cast(pa.large_string())
    offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1)
    data = text.buffers()[2]
    codes = _BYTES[np.frombuffer(data, np.uint8, int(offsets[-1]))] if data else np.zeros(0, int)
    width = len(CLASSES) + 1
    rows = np.repeat(np.arange(len(text)) * width, np.diff(offsets))
    counts = np.bincount(rows + codes, minlength=len(text) * width)
    return counts.reshape(len(text), width)[:, :-1]


def repeated_words(codes: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Words in windows that a text holds twice or more, per text."""
    counts = np.diff(starts)
    n = np.maximum(counts - window + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - starts[:-1], n)
    keys = np.repeat(np.arange(len(n)), n).astype(np.uint64)
    values = codes.astype(np.uint64)
    for k in range(window):
        keys = mixed(keys * np.uint64(0x100000001B3) + values[at + k])
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edges = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(edges, at[again], 1)
    np.add.at(edges, at[again] + window, -1)
    return per_text((np.cumsum(edges)[:-1] > 0).astype(np.int64), starts)


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def _coded(text: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    words, starts = words_of(text, lower)
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, starts


def capacity(least_share: float) -> int:
    return int(np.ceil(4 / least_share))


def summary(counts: np.ndarray, most: int) -> tuple[np.ndarray, int]:
    """Misra-Gries: which of the counts stay, ``most`` at most, and what is taken off all."""
    if len(counts) <= most:
        return np.flatnonzero(counts > 0), 0
    off = int(np.partition(counts, len(counts) - most - 1)[len(counts) - most - 1])
    return np.flatnonzero(counts > off), off


def merged(rows: pd.DataFrame, most: int) -> pd.DataFrame:
    """One summary of a language's summaries; a row without a word has what was taken off and all words."""
    of_words = rows["word"].notna()
    held = rows[of_words].groupby("word", sort=True)["n"].sum()
    stays, off = summary(held.to_numpy(), most)
    rest = rows[~of_words]
    out = pd.DataFrame({"word": held.index[stays], "n": held.to_numpy()[stays] - off, "total": 0})
    last = pd.DataFrame({"word": [None], "n": [rest["n"].sum() + off], "total": [rest["total"].sum()]})
    return pd.concat([out, last], ignore_index=True).assign(
        lang=rows["lang"].iloc[0], part=rows["part"].iloc[0] // FAN_IN
    )[_SUMMARY_NAMES]


_SUMMARY_NAMES = ["lang", "part", "word", "n", "total"]
_SUMMARY = "lang string, part long, word string, n long, total long"


def _summaries(least_share: float) -> Callable:
    """For each language of a task its summary; each chunk's words are merged into it."""
    most = capacity(least_share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen: dict[str, dict[str, int]] = {}
        off: Counter = Counter()
        total: Counter = Counter()
        for batch in chunks(batches):
            codes, words, starts = _coded(batch.column("text"), lower=True)
            langs = batch.column("lang").dictionary_encode()
            lang_of = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(starts))
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                counts = np.bincount(codes[lang_of == k], minlength=len(words))
                total[lang] += int(counts.sum())
                stays, less = summary(counts, most)
                off[lang] += less
                held = seen.setdefault(lang, {})
                for word, n in zip(words.take(pa.array(stays)).to_pylist(), (counts[stays] - less).tolist()):
                    held[word] = held.get(word, 0) + n
                counts = np.fromiter(held.values(), np.int64, len(held))
                stays, less = summary(counts, most)
                if less:
                    names = list(held)
                    seen[lang] = {names[i]: int(counts[i]) - less for i in stays.tolist()}
                    off[lang] += less
        for lang, held in seen.items():
            rows = len(held) + 1
            yield pa.record_batch(
                {
                    "lang": pa.array([lang] * rows, pa.string()),
                    "part": pa.array([part] * rows, pa.int64()),
                    "word": pa.array([*held, None], pa.string()),
                    "n": pa.array([*held.values(), off[lang]], pa.int64()),
                    "total": pa.array([0] * len(held) + [total[lang]], pa.int64()),
                }
            )

    return count


def frequent_words(steps: Steps, texts: DataFrame, least_share: float) -> dict[str, list[str]]:
    """For each language its words that may have ``least_share``, in order; all that have it are there."""
    most = capacity(least_share)
    rows = steps.keep(texts.where("lang is not null").mapInArrow(_summaries(least_share), _SUMMARY))
    parts = (rows.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        groups = rows.groupBy("lang", F.floor(F.col("part") / FAN_IN).alias("to"))
        rows = steps.keep(groups.applyInPandas(lambda block: merged(block, most), _SUMMARY))
        parts = -(-parts // FAN_IN)
    last = rows.where("word is null").select("lang", F.col("n").alias("off"), F.col("total").alias("all"))
    likely = rows.where("word is not null").join(last, "lang")
    likely = likely.where(F.col("n") + F.col("off") >= F.lit(least_share) * F.col("all"))
    out: dict[str, list[str]] = {}
    for row in likely.select("lang", "word").collect():
        out.setdefault(row["lang"], []).append(row["word"])
    return {lang: sorted(words) for lang, words in out.items()}


def _features(common: dict[str, list[str]]) -> Callable:
    values = {lang: pa.array(words, pa.large_string()) for lang, words in common.items()}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            text = batch.column("text")
            codes, words, starts = _coded(text)
            lowered = pc.ascii_lower(words)
            n = np.diff(starts)
            # each text has a count for every common word of its language and one for all others
            lang_of, langs = _languages(batch.column("lang"))
            widths = np.array([len(values.get(lang, ())) + 1 for lang in langs], dtype=np.int64)[lang_of]
            offsets = np.concatenate([[0], np.cumsum(widths)])
            word_lang = np.repeat(lang_of, n)
            bins = np.zeros(len(codes), dtype=np.int64)
            for k, lang in enumerate(langs):
                if lang in values:
                    own = np.flatnonzero(word_lang == k)
                    known = pc.fill_null(pc.index_in(lowered, values[lang]), len(values[lang]))
                    bins[own] = known.to_numpy(zero_copy_only=False)[codes[own]]
            hist = np.bincount(np.repeat(offsets[:-1], n) + bins, minlength=offsets[-1])
            lists = pa.array(offsets.astype(np.int32)), pa.array(hist.astype(np.int32))
            classes = class_counts(text)
            inner = classes.sum(axis=1) - classes[:, CLASSES.index("space")]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "lang": batch.column("lang"),
                    "n_words": pa.array(n, pa.int64()),
                    "word_chars": pa.array(inner, pa.int64()),
                    "n_symbols": pa.array(classes[:, CLASSES.index("symbol")], pa.int64()),
                    "n_dup_lines": pa.array([repeated_lines(t) for t in text.to_pylist()], pa.int64()),
                    "n_repeat_words": pa.array(repeated_words(codes, starts), pa.int64()),
                    "common": pa.ListArray.from_arrays(*lists),
                    "classes": _rows_of(classes),
                }
            )

    return measure


def _languages(column: pa.Array) -> tuple[np.ndarray, list[str | None]]:
    """The number of each row's language, and the languages; null is one of them."""
    coded = column.dictionary_encode(null_encoding="encode")
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


def _rows_of(matrix: np.ndarray) -> pa.Array:
    starts = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(matrix.ravel().astype(np.int32)))


_FEATURES = (
    "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, common array<int>, classes array<int>"
)


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts to a distribution; empty rows are far."""
    total = counts.sum(axis=1, keepdims=True)
    p = counts / np.maximum(total, 1)
    middle = (p + reference) / 2

    def divergence(a: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            terms = np.where(a > 0, a * np.log2(a / middle), 0.0)
        return terms.sum(axis=1)

    out = np.sqrt(np.maximum(divergence(p) + divergence(np.broadcast_to(reference, p.shape)), 0) / 2)
    return np.where(total[:, 0] > 0, out, 1.0)


def _failed(batch: pa.RecordBatch) -> np.ndarray:
    size = batch.column("n_words").to_numpy()
    return (size < LEAST_WORDS) | (100 * batch.column("n_repeat_words").to_numpy() > MOST_REPEATED * size)


def _matrix(lists: pa.Array, rows: np.ndarray) -> np.ndarray:
    """The lists of some rows, which are of one length."""
    return lists.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), -1)


@dataclass
class Reference:
    """Of a language: the bin of each word counted, and the mean histograms."""

    bins: np.ndarray
    words: np.ndarray
    classes: np.ndarray

    def word_counts(self, counts: np.ndarray) -> np.ndarray:
        """Counts of the common words and of all others."""
        out = np.zeros((len(counts), len(self.words)))
        np.add.at(out.T, self.bins, counts.T)
        return out


def _far(found: np.ndarray, limit: tuple, size: np.ndarray) -> np.ndarray:
    return (found > limit[0] + limit[1] / np.sqrt(np.maximum(size, 1))) & (size >= limit[2])


def _judge(references: dict[str, Reference], class_limit: tuple, word_limit: tuple) -> Callable:
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            failed, far = _failed(batch), np.zeros(n, dtype=bool)
            word_distance, class_distance = np.full(n, np.nan), np.full(n, np.nan)
            lang_of, langs = _languages(batch.column("lang"))
            for k, lang in enumerate(langs):
                if lang is None or lang not in references:
                    continue
                own, reference = np.flatnonzero(lang_of == k), references[lang]
                counts = reference.word_counts(_matrix(batch.column("common"), own))
                word_distance[own] = distance(counts, reference.words)
                class_distance[own] = distance(_matrix(batch.column("classes"), own), reference.classes)
                far[own] = _far(
                    word_distance[own], word_limit, batch.column("n_words").to_numpy()[own]
                ) | _far(class_distance[own], class_limit, batch.column("word_chars").to_numpy()[own])
            names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
            yield pa.record_batch(
                [batch.column(name) for name in names]
                + [pa.array(failed), pa.array(~(failed | far))]
                + [pa.array(x, mask=np.isnan(x)) for x in (word_distance, class_distance)],
                names=[*names, "base_failed", "kept", "word_distance", "class_distance"],
            )

    return judge


def quality_by_divergence(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    least_share: float = LEAST_SHARE,
    class_limit: tuple[float, float, float] = CLASS_LIMIT,
    word_limit: tuple[float, float, float] = WORD_LIMIT,
) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    Also the distances to the references of the text's language: word_distance, class_distance.
    """
    measured, _, references = _fit(docs, id_col, text_col, lang_col, least_share)
    return measured.mapInArrow(
        _judge(references, class_limit, word_limit),
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, kept boolean, "
        "word_distance double, class_distance double",
    )


def drop_low_quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    least_share: float = LEAST_SHARE,
    class_limit: tuple[float, float, float] = CLASS_LIMIT,
    word_limit: tuple[float, float, float] = WORD_LIMIT,
) -> DataFrame:
    """The rows and columns of ``docs`` whose text is kept.

    Each text is judged where it is, so nothing is shuffled.
    """
    _, common, references = _fit(docs, id_col, text_col, lang_col, least_share)

    @F.arrow_udf("boolean")
    def kept(text: pa.Array, lang: pa.Array) -> pa.Array:
        nothing = pa.nulls(len(text), pa.int64())
        rows = pa.record_batch({"doc_id": nothing, "lang": lang, "text": pc.fill_null(text, "")})
        judge = _judge(references, class_limit, word_limit)
        found = [batch.column("kept") for batch in judge(_features(common)(iter([rows])))]
        return pa.concat_arrays(found) if found else pa.array([], pa.bool_())

    return docs.where(kept(docs[text_col].cast("string"), docs[lang_col].cast("string")))


def _fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, least_share: float) -> tuple:
    """Measures of all documents, the words counted by language, and the references."""
    import_on_executors(docs.sparkSession)
    steps = Steps(docs.sparkSession)
    texts = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        docs[lang_col].cast("string").alias("lang"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )
    common = frequent_words(steps, texts, least_share)
    measured = steps.keep(texts.mapInArrow(_features(common), _FEATURES))
    steps.drop_all_but(measured)
    return measured, common, references_of(measured, least_share)


_SUMS = "lang string, kind int, place int, n long, share decimal(38,0)"
_WORDS, _CLASSES, _DOCUMENTS = 0, 1, 2


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By language: counts of each common word, and shares of passing documents added up."""
    held: dict[tuple[str, int], np.ndarray] = {}
    for batch in batches:
        passed = ~_failed(batch)
        lang_of, langs = _languages(batch.column("lang"))
        for k, lang in enumerate(langs):
            if lang is None:
                continue
            own = np.flatnonzero(lang_of == k)
            good = passed[own]
            found = {_DOCUMENTS: np.array([[good.sum()], [0]], dtype=np.int64)}
            for kind, name in ((_WORDS, "common"), (_CLASSES, "classes")):
                counts = _matrix(batch.column(name), own).astype(np.int64)
                total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
                shares = np.rint(counts / total * UNIT).astype(np.int64)[good]
                found[kind] = np.stack([counts.sum(axis=0), shares.sum(axis=0)])
            for kind, sums in found.items():
                held[lang, kind] = held.get((lang, kind), 0) + sums
    for (lang, kind), sums in held.items():
        rows = sums.shape[1]
        yield pa.record_batch(
            {
                "lang": pa.array([lang] * rows, pa.string()),
                "kind": pa.array([kind] * rows, pa.int32()),
                "place": pa.array(np.arange(rows), pa.int32()),
                "n": pa.array(sums[0], pa.int64()),
                "share": pa.array(sums[1], pa.int64()).cast(pa.decimal128(38, 0)),
            }
        )


def references_of(measured: DataFrame, least_share: float) -> dict[str, Reference]:
    """The references of each language with enough passing documents."""
    sums = measured.where("lang is not null").mapInArrow(_sums, _SUMS)
    sums = sums.groupBy("lang", "kind", "place").agg(F.sum("n").alias("n"), F.sum("share").alias("share"))
    held: dict[str, dict[int, list]] = {}
    for row in sums.collect():
        kinds = held.setdefault(row["lang"], {_WORDS: [], _CLASSES: [], _DOCUMENTS: []})
        kinds[row["kind"]].append((row["place"], row["n"], float(row["share"])))
    out = {}
    for lang, kinds in held.items():
        if kinds[_DOCUMENTS][0][1] < ENOUGH_DOCUMENTS:
            continue
        _, counts, shares = (np.array(x) for x in zip(*sorted(kinds[_WORDS])))
        # the last place has all other words, and those that turned out too rare join it
        often = counts >= least_share * counts.sum()
        often[-1] = False
        bins = np.where(often, np.cumsum(often) - 1, often.sum())
        words = np.bincount(bins, weights=shares, minlength=int(often.sum()) + 1)
        classes = np.array([share for _, _, share in sorted(kinds[_CLASSES])])
        out[lang] = Reference(bins, words / words.sum(), classes / classes.sum())
    return out
