"""Toxicity by weak supervision (operator 9).

Method. Sixteen voters look at a text: eight word-list and three word-beginning
lists, three counts of listed words, two patterns. The lists hold words and beginnings that
mark toxic documents among labelled training rows: by a log-likelihood-ratio test of
``LEAST_RATIO`` and a rate of at least twelve times that of other documents, from three toxic
documents on; and there is a short general list. A generative label model is fitted
on the votes of all training documents, labelled or not: for toxic and for other texts
it has a term for each voter (its accuracy) and, shared by both, a term for each
pair of voters that agree beyond what the label explains. Expectation maximisation fits
all terms at once; with 2**16 patterns of votes the sums over all patterns are exact, and
Spark counts how often each occurs. A voter that repeats another so adds nothing. A logistic
classifier over hashed list words, votes and counts then learns the model's posterior labels
on a sample of at most ``most_rows`` labelled training rows, up to half of them of
each given label, drawn by hash of the id.

Lists. Nothing is cut from them, and no floor grows with the labels. Up to ``MOST_HELD``
entries go to the tasks as they are; longer lists stay a table, which the words
of each text are joined with.

Only rows with crc32(id as text) mod 3 <> 1 are learned from. Ids, languages and
sources are never inputs of a score.

Defined cases. Null text is empty and gets the score of a text without votes.
Rows that repeat an id are scored each; a label belongs to every row with its
id, and an id that has different labels counts as toxic. Without usable labels,
or with one kind only, the label model scores alone, on the general list and the
patterns.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import Steps, chunks, fresh_names, id_and_text, per_text, remainder, words_of

FOLDS, HELD_FOLD = 3, 1
THRESHOLD = 0.7
MOST_ROWS = 20_000
#: Entries of a list that tasks get as they are, some tens of megabytes; longer lists are joined.
MOST_HELD = 200_000
#: An entry is in so many toxic documents, and so significantly more often than in others.
LEAST_TOXIC, LEAST_RATIO, LEAST_STRENGTH = 3, 10.83, 2.5
#: Voters are a pair if they agree so much, and significantly, beyond what the label explains, on so many texts.
RELATED, LEAST_AGREED = 0.1, 10
#: Passes over all margins in the first round of the fit, and in each later one.
FIRST_SWEEPS, SWEEPS = 150, 2
BEGINNING = 5
LISTS, BEGINNINGS = 8, 3
VOTERS = 16
HASHED = 256
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”‘’…"

#: Insults of everyday English, German, French and Spanish.
GENERAL = (
    "idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting",
    "dumb", "idioten", "dumm", "abschaum", "versager", "imbécile", "crétin", "connard", "débile",
    "estúpido", "imbécil", "escoria", "idiota", "inútil",
)

_COUNTS = "n_hits int, n_general int, shouted boolean, aimed boolean, n_words int"
_SIGNALS = f"doc_id long, slots array<int>, strengths array<double>, lists int, {_COUNTS}"
_YOU = pa.array(["you", "you're", "your", "du", "ihr", "tu", "vous", "tú", "eres"], pa.large_string())


def _large(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def _kinds(text: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array, np.ndarray]:
    """Codes of words; the words lowered and without marks at their edges; their beginnings."""
    words, starts = words_of(text)
    coded = words.dictionary_encode()
    plain = pc.utf8_lower(pc.utf8_trim(coded.dictionary, EDGES))
    long = pc.greater(pc.utf8_length(plain), BEGINNING)
    heads = pc.if_else(long, pc.utf8_slice_codeunits(plain, 0, BEGINNING), _large(""))
    return coded.indices.to_numpy(zero_copy_only=False), plain, heads, starts


def _entries(text: pa.Array, known: pa.Array | None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct entries of each text: values, and for each hit its text and value.

    An entry is a word, or a beginning followed by ``*``. With ``known``, values are those.
    """
    codes, plain, heads, starts = _kinds(text)
    rows = np.repeat(np.arange(len(text)), np.diff(starts))
    starred = pc.binary_join_element_wise(heads, _large("*"), _large(""))
    if known is None:
        both = pa.concat_arrays([plain, starred])
        coded = both.dictionary_encode()
        values, ids = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    else:
        values = known
        found = [pc.fill_null(pc.index_in(x, known), -1) for x in (plain, starred)]
        ids = np.concatenate([x.to_numpy(zero_copy_only=False) for x in found])
    n = len(plain)
    hits_row = np.concatenate([rows, rows])
    hits = np.concatenate([ids[:n][codes], ids[n:][codes]]) if n else np.zeros(0, np.int64)
    keep = hits >= 0
    pairs = np.unique(hits_row[keep] * np.int64(len(values) + 1) + hits[keep])
    return values, pairs // (len(values) + 1), pairs % (len(values) + 1)


def _held_by(known: pa.Array | None) -> Callable:
    """In how many toxic and other documents of the task each entry is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            values, rows, hits = _entries(batch.column("text"), known)
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            bad = np.bincount(hits, weights=toxic[rows], minlength=len(values)).astype(np.int64)
            every = np.bincount(hits, minlength=len(values))
            some = pa.array(np.flatnonzero(every))
            yield pa.record_batch(
                {
                    "entry": values.take(some).cast(pa.string()),
                    "toxic": pa.array(bad).take(some),
                    "other": pa.array(every - bad).take(some),
                }
            )

    return count


@dataclass
class Lexicon:
    """Entries in order with how strongly each marks toxic texts, or a table of them."""

    entries: list[str]
    strength: np.ndarray
    rows: DataFrame | None = None


def ratio(toxic: Column, other: Column, all_toxic: int, all_other: int) -> Column:
    """The log-likelihood ratio of an entry's counts against one rate in all documents."""
    n, total = toxic + other, all_toxic + all_other

    def term(found: Column, documents: int, held: Column) -> Column:
        expected = held * F.lit(documents / total)
        return F.when(found > 0, found * F.log(found / expected)).otherwise(F.lit(0.0))

    return 2 * (
        term(toxic, all_toxic, n)
        + term(other, all_other, n)
        + term(all_toxic - toxic, all_toxic, total - n)
        + term(all_other - other, all_other, total - n)
    )


def _listed(steps: Steps, labelled: DataFrame) -> Lexicon | None:
    """Entries that mark toxic documents, with the logarithm of how strongly."""
    totals = labelled.agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("other")
    ).first()
    all_toxic, all_other = totals["toxic"] or 0, totals["other"] or 0
    if not all_toxic or not all_other:
        return None
    kinds = "entry string, toxic long, other long"
    often = steps.keep(
        labelled.where("toxic = 1")
        .mapInArrow(_held_by(None), kinds)
        .groupBy("entry")
        .agg(F.sum("toxic").alias("toxic"))
        .where((F.col("toxic") >= LEAST_TOXIC) & ~F.col("entry").isin("", "*"))
    )
    # other documents are searched for these entries, or, if there are very many, joined with them
    few = often.count() <= MOST_HELD
    values = pa.array(sorted(r["entry"] for r in often.collect()), pa.large_string()) if few else None
    found = labelled.where("toxic = 0").mapInArrow(_held_by(values), kinds).drop("toxic")
    counted = often.join(found.groupBy("entry").agg(F.sum("other").alias("other")), "entry", "left")
    counted = counted.select("entry", "toxic", F.coalesce("other", F.lit(0)).alias("other"))
    strength = F.log(F.col("toxic") / all_toxic / ((F.col("other") + 0.5) / all_other))
    rows = steps.keep(
        counted.withColumn("strength", strength).where(
            (ratio(F.col("toxic"), F.col("other"), all_toxic, all_other) >= LEAST_RATIO)
            & (F.col("toxic") >= F.col("other"))
            & (F.col("strength") >= LEAST_STRENGTH)
        ).select("entry", "strength")
    )
    n = rows.count()
    if n > MOST_HELD:
        return Lexicon([], np.zeros(0), rows)
    held = sorted((row["entry"], row["strength"]) for row in rows.collect())
    return Lexicon([e for e, _ in held], np.array([s for _, s in held])) if held else None


def _slot(entry: str) -> int:
    return zlib.crc32(entry.encode()) % HASHED


def _voter(entry: str) -> int:
    """The word-list or word-beginning voter of an entry, by hash."""
    h = zlib.crc32(entry.encode())
    return LISTS + h % BEGINNINGS if entry.endswith("*") else h % LISTS


def _after_address(codes: np.ndarray, is_you: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Words at most three after an address, in the same text."""
    out = np.zeros(len(codes), dtype=bool)
    address = is_you[codes] if len(codes) else out
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    for step in (1, 2, 3):
        out[step:] |= address[:-step] & (owner[step:] == owner[:-step])
    return out


def _shouted(text: pa.Array) -> pa.Array:
    return pc.match_substring_regex(text, r"[A-ZÀ-Þ]{4,}[^a-zß-ÿ]{0,3}!{1,}")


def _signals(lexicon: Lexicon) -> Callable:
    """What the voters and the classifier look at, for lists that tasks hold."""
    known = pa.array(lexicon.entries, pa.large_string())
    general = pa.array(GENERAL, pa.large_string())
    slots = np.array([_slot(e) for e in lexicon.entries], dtype=np.int32)
    voters = np.array([1 << _voter(e) for e in lexicon.entries], dtype=np.int32)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            text = batch.column("text")
            codes, plain, heads, starts = _kinds(text)
            n = len(text)
            _, rows, hits = _entries(text, known)
            offsets = pa.array(np.searchsorted(rows, np.arange(n + 1)).astype(np.int32))
            lists = np.zeros(n, dtype=np.int32)
            np.bitwise_or.at(lists, rows, voters[hits])
            is_general = pc.is_in(plain, general).to_numpy(zero_copy_only=False)
            starred = pc.binary_join_element_wise(heads, _large("*"), _large(""))
            is_hit = is_general | pc.is_in(plain, known).to_numpy(zero_copy_only=False)
            is_hit |= pc.is_in(starred, known).to_numpy(zero_copy_only=False)
            is_you = pc.is_in(plain, _YOU).to_numpy(zero_copy_only=False)
            nothing = np.zeros(0, dtype=bool)
            in_general, in_hit = (x[codes] if len(plain) else nothing for x in (is_general, is_hit))
            aimed = _after_address(codes, is_you, starts) & in_hit
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "slots": pa.ListArray.from_arrays(offsets, pa.array(slots[hits])),
                    "strengths": pa.ListArray.from_arrays(offsets, pa.array(lexicon.strength[hits])),
                    "lists": pa.array(lists),
                    "n_hits": pa.array(per_text(in_hit.astype(np.int64), starts), pa.int32()),
                    "n_general": pa.array(per_text(in_general.astype(np.int64), starts), pa.int32()),
                    "shouted": _shouted(text),
                    "aimed": pa.array(per_text(aimed.astype(np.int64), starts) > 0),
                    "n_words": pa.array(np.diff(starts), pa.int32()),
                }
            )

    return look


_WORDS = "h1 long, h2 long, plain string, starred string, times long, general boolean, near boolean, shouted boolean, n_words int"


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each text, and a row without a word for each text."""
    general = pa.array(GENERAL, pa.large_string())
    for batch in chunks(batches):
        text = batch.column("text")
        codes, plain, heads, starts = _kinds(text)
        n, size = len(text), len(plain)
        near = _after_address(codes, pc.is_in(plain, _YOU).to_numpy(zero_copy_only=False), starts)
        owner = np.repeat(np.arange(n), np.diff(starts))
        held, place, times = np.unique(owner * np.int64(size + 1) + codes, return_inverse=True, return_counts=True)
        rows, words = held // (size + 1), pa.array(held % (size + 1))
        aimed = np.bincount(place, weights=near, minlength=len(held)) > 0
        starred = pc.binary_join_element_wise(heads, _large("*"), _large(""))
        keys = {h: batch.column(h).take(pa.array(rows)) for h in ("h1", "h2")}
        yield pa.record_batch(
            {
                **keys,
                "plain": plain.take(words).cast(pa.string()),
                "starred": starred.take(words).cast(pa.string()),
                "times": pa.array(times, pa.int64()),
                "general": pc.is_in(plain, general).take(words),
                "near": pa.array(aimed),
                "shouted": pa.nulls(len(held), pa.bool_()),
                "n_words": pa.nulls(len(held), pa.int32()),
            }
        )
        yield pa.record_batch(
            {
                "h1": batch.column("h1"),
                "h2": batch.column("h2"),
                "plain": pa.nulls(n, pa.string()),
                "starred": pa.nulls(n, pa.string()),
                "times": pa.nulls(n, pa.int64()),
                "general": pa.nulls(n, pa.bool_()),
                "near": pa.nulls(n, pa.bool_()),
                "shouted": _shouted(text),
                "n_words": pa.array(np.diff(starts), pa.int32()),
            }
        )


def _keys(id_col: Column, text_col: Column) -> list[Column]:
    """128 bits that tell rows of other ids or texts apart; null text counts as empty."""
    text = F.coalesce(text_col.cast("string"), F.lit(""))
    return [F.xxhash64(F.lit(k), id_col.cast("long"), text) for k in (1, 2)]


def _signals_by_join(texts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """The same from a table of entries, with the keys h1 and h2 of each text.

    Rows of one id and text have one row here.
    """
    crc, star = F.crc32(F.col("entry").cast("binary")), F.col("entry").endswith("*")
    voter = F.when(star, LISTS + crc % BEGINNINGS).otherwise(crc % LISTS)
    bit = F.pow(F.lit(2), voter).cast("int")
    listed = lexicon.select(
        "entry",
        F.struct(
            "entry", (crc % HASHED).cast("int").alias("slot"), "strength", bit.alias("bit")
        ).alias("found"),
    )
    h1, h2 = _keys(F.col("doc_id"), F.col("text"))
    words = texts.select(h1.alias("h1"), h2.alias("h2"), "text").mapInArrow(_words, _WORDS)
    for name in ("plain", "starred"):
        side = listed.select(F.col("entry").alias(name), F.col("found").alias(f"by_{name}"))
        words = words.join(side.hint("merge"), name, "left")
    hit = F.col("general") | F.col("by_plain").isNotNull() | F.col("by_starred").isNotNull()
    both = F.flatten(F.collect_list(F.array_compact(F.array("by_plain", "by_starred"))))
    copies = F.count("n_words")

    def each(total: Column) -> Column:
        return F.coalesce((total / copies).cast("int"), F.lit(0))

    found = words.groupBy("h1", "h2").agg(
        F.array_sort(F.array_distinct(both)).alias("found"),
        each(F.sum(F.when(hit, F.col("times")))).alias("n_hits"),
        each(F.sum(F.when(F.col("general"), F.col("times")))).alias("n_general"),
        F.max("shouted").alias("shouted"),
        F.coalesce(F.max(F.col("near") & hit), F.lit(False)).alias("aimed"),
        F.max("n_words").alias("n_words"),
    )
    bits = F.aggregate("found", F.lit(0), lambda held, x: held.bitwiseOR(x["bit"]))
    found = found.withColumns(
        {
            "slots": F.transform("found", lambda x: x["slot"]),
            "strengths": F.transform("found", lambda x: x["strength"]),
            "lists": bits,
        }
    )
    return found.drop("found")


def _votes(batch: pa.RecordBatch) -> np.ndarray:
    """Votes of each row, one column per voter."""
    n = batch.num_rows
    out = np.zeros((n, VOTERS), dtype=bool)
    at = LISTS + BEGINNINGS
    out[:, :at] = batch.column("lists").to_numpy()[:, None] >> np.arange(at) & 1
    hits, words = batch.column("n_hits").to_numpy(), batch.column("n_words").to_numpy()
    out[:, at] = hits >= 2
    out[:, at + 1] = hits * 100 >= np.maximum(words, 1)
    out[:, at + 2] = batch.column("n_general").to_numpy() >= 1
    out[:, at + 3] = batch.column("aimed").to_numpy(zero_copy_only=False)
    out[:, at + 4] = batch.column("shouted").to_numpy(zero_copy_only=False)
    return out


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        votes = _votes(batch) @ (1 << np.arange(VOTERS))
        found, n = np.unique(votes, return_counts=True)
        yield pa.record_batch({"pattern": pa.array(found, pa.int32()), "n": pa.array(n, pa.int64())})


class LabelModel:
    """How voters vote on toxic and on other texts: a term for each, and for pairs that agree.

    Among toxic texts (row 1 of ``terms``) and others (row 0) the probability of a pattern is
    in proportion to exp(sum of the terms of those who vote + sum of the shared terms of the
    pairs that both vote).
    """

    def __init__(self, patterns: np.ndarray, weights: np.ndarray, voters: int = VOTERS, rounds: int = 100):
        self.voters, total = voters, weights.sum()
        votes = (patterns[:, None] >> np.arange(voters) & 1).astype(float)
        posterior = self._alone(votes, weights)
        both = votes.T @ (votes * weights[:, None])
        self.pairs = [(int(j), int(k)) for j, k in np.argwhere(self._related(total) & (both >= LEAST_AGREED))]
        agreed = np.array([both[pair] for pair in self.pairs]) / total
        self.terms = np.log([self.false / (1 - self.false), self.hit / (1 - self.hit)])
        self.shared = np.zeros(len(self.pairs))
        for k in range(rounds):
            self._shares(weights, posterior, votes)
            # at first the terms of pairs must grow, or related voters would all count in full
            logs = self._logs()
            p = np.exp(logs - logs.max(axis=1, keepdims=True))
            for _ in range(SWEEPS if k else FIRST_SWEEPS):
                self._sweep(p, agreed)
            logs = self._logs()
            most = logs.max(axis=1, keepdims=True)
            self.scale = most[:, 0] + np.log(np.exp(logs - most).sum(axis=1))
            before, posterior = posterior, self.posterior(votes)
            if np.abs(posterior - before).max() < 1e-5:
                break

    def _logs(self) -> np.ndarray:
        """The sum of terms of each pattern, among others and among toxic texts."""
        out = np.zeros((2, 1 << self.voters))
        for j in range(self.voters):
            self._voting(out, j)[...] += self.terms[:, j][:, None, None]
        for (j, k), term in zip(self.pairs, self.shared):
            self._voting(out, j, k)[...] += term
        return out

    @staticmethod
    def _voting(p: np.ndarray, j: int, k: int | None = None) -> np.ndarray:
        """A view of the patterns in which a voter, or both of a pair, vote."""
        if k is None:
            return p.reshape(2, -1, 2, 1 << j)[:, :, 1, :]
        return p.reshape(2, -1, 2, 1 << k - j - 1, 2, 1 << j)[:, :, 1, :, 1, :]

    def _sweep(self, p: np.ndarray, agreed: np.ndarray) -> None:
        """Each margin in turn is made what the labelled votes have: no step lowers the likelihood."""
        sides = np.array([1 - self.prior, self.prior])
        size = p.sum(axis=1)
        for j in range(self.voters):
            part = self._voting(p, j)
            held = part.sum(axis=(1, 2))
            share = np.clip(held / size, 1e-12, 1 - 1e-12)
            wanted = np.array([self.false[j], self.hit[j]])
            grown = wanted / (1 - wanted) * (1 - share) / share
            part *= grown[:, None, None]
            size += held * (grown - 1)
            self.terms[:, j] += np.log(grown)
        for e, wanted in enumerate(agreed):
            part = self._voting(p, *self.pairs[e])
            held = part.sum(axis=(1, 2, 3))
            step = self._step(sides, np.clip(held / size, 1e-12, 1 - 1e-12), wanted, self.shared[e])
            part *= np.exp(step)
            size += held * (np.exp(step) - 1)
            self.shared[e] += step
        p /= size[:, None]

    def _shares(self, weights: np.ndarray, posterior: np.ndarray, votes: np.ndarray) -> None:
        toxic, total = (weights * posterior).sum(), weights.sum()
        self.prior = float(np.clip(toxic / total, 1e-4, 0.5))
        hit = ((weights * posterior) @ votes + 0.5) / (toxic + 1)
        false = ((weights * (1 - posterior)) @ votes + 0.05) / (total - toxic + 1)
        # a voter speaks for toxicity or not at all
        self.hit, self.false = np.clip(hit, 1e-5, 0.999), np.clip(np.minimum(false, hit), 1e-6, 0.99)

    def _alone(self, votes: np.ndarray, weights: np.ndarray, rounds: int = 200) -> np.ndarray:
        """Posteriors to start from: voters are independent, but related ones share one say."""
        # at the start, texts with a vote, be it but for shouting, are held toxic
        posterior, say = np.where(votes[:, : VOTERS - 1].any(axis=1), 0.9, 0.01), 1.0
        for _ in range(rounds):
            self._shares(weights, posterior, votes)
            self.terms = np.log([self.false / (1 - self.false), self.hit / (1 - self.hit)]) * say
            self.scale = -(np.log([1 - self.false, 1 - self.hit]) * say).sum(axis=1)
            before, posterior = posterior, self.posterior(votes)
            say = 1 / (1 + np.maximum(self._left(votes, weights, posterior), 0).sum(axis=1))
            if np.abs(posterior - before).max() < 1e-6:
                break
        return posterior

    def _left(self, votes: np.ndarray, weights: np.ndarray, posterior: np.ndarray) -> np.ndarray:
        """How votes still go together once the label is taken out."""
        expected = posterior[:, None] * self.hit + (1 - posterior[:, None]) * self.false
        left = (votes - expected) * np.sqrt(weights)[:, None]
        shared = left.T @ left
        size = np.sqrt(np.maximum(np.diag(shared), 1e-12))
        self.correlation = shared / np.outer(size, size)
        np.fill_diagonal(self.correlation, 0)
        return self.correlation

    def _related(self, total: float) -> np.ndarray:
        """Which voters agree beyond what the label explains, by the lower of their numbers first."""
        found = np.triu(self.correlation, 1)
        return (found > RELATED) & (found**2 * total >= LEAST_RATIO)

    @staticmethod
    def _step(sides: np.ndarray, held: np.ndarray, wanted: float, now: float) -> float:
        """What to add to a pair's term so that it votes together as often as wanted."""
        low, high = -20 - now, 20 - now
        for _ in range(60):
            step = (low + high) / 2
            grown = np.exp(step)
            if (sides * held * grown / (1 - held + held * grown)).sum() < wanted:
                low = step
            else:
                high = step
        return step

    @property
    def weights(self) -> tuple[np.ndarray, float]:
        """The logit of the posterior is linear in the votes, as the terms of pairs are shared."""
        prior = np.log(self.prior / (1 - self.prior))
        return self.terms[1] - self.terms[0], float(prior - self.scale[1] + self.scale[0])

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        each, rest = self.weights
        return 1 / (1 + np.exp(-np.clip(votes @ each + rest, -40, 40)))


def _inputs(batch: pa.RecordBatch) -> np.ndarray:
    """Inputs of the classifier: hashed entries by strength, votes, counts, one."""
    n = batch.num_rows
    out = np.zeros((n, HASHED + VOTERS + 3), dtype=np.float32)
    slots, strengths = batch.column("slots"), batch.column("strengths")
    rows = np.repeat(np.arange(n), pc.list_value_length(slots).to_numpy(zero_copy_only=False))
    flat = [x.flatten().to_numpy(zero_copy_only=False) for x in (slots, strengths)]
    np.add.at(out, (rows, flat[0]), flat[1] / 5)
    out[:, HASHED:-3] = _votes(batch)
    hits, words = batch.column("n_hits").to_numpy(), batch.column("n_words").to_numpy()
    out[:, -3] = np.log1p(hits)
    out[:, -2] = np.minimum(1.0, 20 * hits / np.maximum(words, 1))
    out[:, -1] = 1
    return out


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 400, rate: float = 0.05) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Adam with a small penalty."""
    w = np.zeros(x.shape[1])
    first = second = np.zeros(x.shape[1])
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (p - y) / len(y) + 1e-5 * w
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        w = w - rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return w


def _scores(weights: np.ndarray, signals: pa.RecordBatch) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_inputs(signals) @ weights, -40, 40)))


def _score(weights: np.ndarray, *keys: str) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {key: batch.column(key) for key in keys}
            yield pa.record_batch({**columns, "score": pa.array(_scores(weights, batch), pa.float64())})

    return score


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "toxic",
    most_rows: int = MOST_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from ``threshold``)."""
    signals, _, weights = _fit(docs, labels, id_col, text_col, label_id_col, label_col, most_rows)
    scored = signals.mapInArrow(_score(weights, "doc_id"), "doc_id long, score double")
    return scored.select(
        "doc_id",
        (remainder("doc_id", FOLDS) == HELD_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "toxic",
    most_rows: int = MOST_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows and columns of ``docs`` whose text scores below ``threshold``.

    The classifier looks at each text where it is, so nothing is shuffled, unless the
    lists are so long that they are a table.
    """
    signals, lexicon, weights = _fit(docs, labels, id_col, text_col, label_id_col, label_col, most_rows)
    if lexicon.rows is not None:
        keys = fresh_names(docs.columns, "h1", "h2")
        scored = signals.mapInArrow(_score(weights, "h1", "h2"), "h1 long, h2 long, score double")
        good = scored.where(F.col("score") < threshold).select("h1", "h2").distinct().toDF(*keys)
        keyed = docs.withColumns(dict(zip(keys, _keys(docs[id_col], docs[text_col]))))
        return keyed.join(good.hint("merge"), keys, "left_semi").select(*docs.columns)

    @F.arrow_udf("boolean")
    def kept(text: pa.Array) -> pa.Array:
        rows = pa.record_batch({"doc_id": pa.nulls(len(text), pa.int64()), "text": pc.fill_null(text, "")})
        found = [_scores(weights, batch) for batch in _signals(lexicon)(iter([rows]))]
        return pa.array(np.concatenate(found) < threshold if found else np.zeros(0, dtype=bool))

    return docs.where(kept(docs[text_col].cast("string")))


def _fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    label_id_col: str,
    label_col: str,
    most_rows: int,
) -> tuple[DataFrame, Lexicon, np.ndarray]:
    """Signals of all documents, the lists, and the classifier learned from the training rows."""
    steps = Steps(docs.sparkSession)
    texts = id_and_text(docs, id_col, text_col)
    training = remainder("doc_id", FOLDS) != HELD_FOLD
    known = (
        labels.select(
            labels[label_id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("toxic")
        )
        .where(training & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        # labels grow with the documents, so they aren't broadcast even where they are few
        .hint("merge")
    )
    labelled = texts.where(training).join(known, "doc_id").select("doc_id", "text", "toxic")
    found = _listed(steps, steps.keep(labelled.select("text", "toxic")))
    lexicon = found or Lexicon(sorted(GENERAL), np.full(len(GENERAL), 5.0))
    if lexicon.rows is None:
        signals = steps.keep(texts.mapInArrow(_signals(lexicon), _SIGNALS))
    else:
        h1, h2 = _keys(F.col("doc_id"), F.col("text"))
        rows = texts.select("doc_id", h1.alias("h1"), h2.alias("h2"))
        signals = steps.keep(rows.join(_signals_by_join(texts, lexicon.rows).hint("merge"), ["h1", "h2"]))

    votes = signals.where(training).mapInArrow(_patterns, "pattern int, n long")
    rows = votes.groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    patterns = np.array([row["pattern"] for row in rows] or [0])
    counts = np.array([row["n"] for row in rows] or [1], dtype=float)
    model = LabelModel(patterns, counts)

    sample = _sample(signals.where(training), known, most_rows)
    if found and sample.num_rows:
        weights = _logistic(_inputs(sample), model.posterior(_votes(sample).astype(float)))
    else:
        # no labelled texts of both kinds to learn from: the classifier repeats the label model
        weights = np.zeros(HASHED + VOTERS + 3)
        weights[HASHED:-3], weights[-1] = model.weights
    steps.drop_all_but(signals)
    return signals, lexicon, weights


def _sample(signals: DataFrame, known: DataFrame, most_rows: int) -> pa.RecordBatch:
    """At most half of ``most_rows`` of each label, the first by hash of the id."""
    order = [F.xxhash64("doc_id"), F.col("n_words"), F.col("n_hits"), F.col("lists")]
    joined = signals.join(known, "doc_id")
    parts = [joined.where(F.col("toxic") == k).orderBy(*order).limit(most_rows // 2) for k in (0, 1)]
    rows = parts[0].union(parts[1]).toArrow().combine_chunks()
    if not rows.num_rows:
        return pa.RecordBatch.from_pylist([], schema=rows.schema)
    return rows.to_batches()[0]
