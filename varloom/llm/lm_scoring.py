"""Operator 7, LM scoring: a causal self-attention model on subword ids, mixed with the corpus's word counts.

1. Words are counted in each task over all learning texts and summed by Spark; nothing bounds their number.
2. The distinct words, weighted by their counts, give the counts of subword ids that fold the vocabulary into classes.
3. The attention model is trained in numpy on every window of all learning texts, by tasks whose models are averaged in
   rounds; windows, batches and tasks grow with the corpus.
4. One Arrow map scores each text: words that stand in the table of commonest words (a bounded broadcast) are done at
   once; each occurrence of another word is handed on with its log p. These rows join with the counts by word.

p(word | before) = SEEN * max(count - D, 0) / N + rest * p_model(word | before), with the discount D from the numbers of
words that stand once and twice and the rest what is left of 1. p_model of a word is the product over its subwords, the
first given that a word or the end begins there, times the probability that the next subword begins another: so over all
words (as strings of subwords) and the end it sums to one, and so does p. score is the log10 of the product over a text.
"""

from __future__ import annotations

import base64
import uuid
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.attention import BATCH, OVERLAP, ROUNDS, SCORED, STEPS, TASKS, WIDE, Attention, Folding, all_spans, unspan
from varloom.llm.common import durable, held_out, key_rows, slices, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Words whose counts every task holds, and their greatest length.
COMMON_WORDS, COMMON_BYTES = 400_000, 64
#: Weight of the discounted counts.
SEEN = 0.88
#: The share of the text that the model is trained on, all of it, and the words of the parts that texts are cut into.
DRAWN, PART = 1.0, 128
#: Words that a worker remembers before it forgets them, and bytes of words that it counts at a time.
HELD_WORDS, HELD_BYTES = 400_000, 64 << 20
#: Texts that are coded at a time.
TEXTS = 2_000
LN10 = float(np.log(10))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").lower().split()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """words_of() all texts, one after the other, and where each text's begin and the last one's end."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words, at = lists.values, lists.offsets.to_numpy()
    full = pc.binary_length(words).to_numpy() > 0  # blanks at a text's ends give empty words
    if not full.all():
        words, at = words.filter(pa.array(full)), np.append(0, np.cumsum(full))[at]
    return words, at.astype(np.int64)


class Subwords(dict):
    """word -> a number; ids of word n: pool[start[n] : start[n] + size[n]]. Each word is encoded with a space before it.

    The common words have the numbers 0 to len(common) - 1 and are never forgotten; other words are, all at once, when
    HELD_WORDS are known."""

    def __init__(self, path: str, common: tuple[bytes, ...] = ()):
        super().__init__()
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.end = max(ranks.values()) + 1
        self.n_ids = self.end + 1
        if self.n_ids > 65_536:
            raise ValueError("ids don't fit 16 bits")
        self.begins = np.zeros(self.n_ids, bool)  # ids that begin a word, and the end
        self.begins[[*(i for piece, i in ranks.items() if piece[:1] == b" "), self.end]] = True
        self._core = tiktoken.Encoding("subwords", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.common = common
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self._pool, self._start, self._size = array("H"), array("q"), array("q")
        for w in self.common:
            self[w]
        self[b""] = self.end_number = len(self._start)  # no word is empty, so this stands for the end
        self._start.append(len(self._pool))
        self._size.append(1)
        self._pool.append(self.end)

    def __missing__(self, word: bytes) -> int:
        ids, n = self._core.encode_single_piece(b" " + word), len(self._start)
        self._start.append(len(self._pool))
        self._size.append(len(ids))
        self._pool.extend(ids)
        self[word] = n
        return n

    def code(self, texts: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each text: numbers of its words, ids of its words and the end, where each word's ids begin."""
        if len(self) > HELD_WORDS + len(self.common):
            self._forget()
        numbers = [np.fromiter(map(self.__getitem__, w), np.int64, len(w)) for w in texts]
        pool, start, size = (np.frombuffer(x, x.typecode) for x in (self._pool, self._start, self._size))
        out = []
        for k in numbers:
            n = size[k]
            begins = np.append(0, np.cumsum(n))
            ids = np.full(begins[-1] + 1, self.end, np.uint16)
            ids[:-1] = pool[np.repeat(start[k] - begins[:-1], n) + np.arange(begins[-1])]
            out.append((k, ids, begins))
        return out

    def code_texts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all texts, one after the other, each with an end: words without the ends; numbers of words and ends; their ids;
        where each word's ids begin; where each text's numbers begin. The last two have one more place at their ends."""
        if len(self) > HELD_WORDS + len(self.common):
            self._forget()
        words, at = split_words(texts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_pylist()
        numbers = np.fromiter(map(self.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        numbers = np.insert(numbers, at[1:], self.end_number)
        at = at + np.arange(len(at))
        pool, start, size = (np.frombuffer(x, x.typecode) for x in (self._pool, self._start, self._size))
        n = size[numbers]
        begins = np.append(0, np.cumsum(n))
        return words, numbers, pool[np.repeat(start[numbers] - begins[:-1], n) + np.arange(begins[-1])], begins, at


@lru_cache(maxsize=2)
def subwords(path: str) -> Subwords:
    return Subwords(path)


_WITH_COMMON: dict = {}


def with_common(path: str, common: list[bytes], run: str) -> Subwords:
    """A worker's table for one run of the operator."""
    if run not in _WITH_COMMON:
        _WITH_COMMON.clear()
        _WITH_COMMON[run] = Subwords(path, tuple(common))
    return _WITH_COMMON[run]


def _count(batches):
    held = []

    def flush():
        got = pa.chunked_array(held, pa.binary()).value_counts()
        held.clear()
        return pa.RecordBatch.from_arrays([got.field("values"), got.field("counts")], ["word", "n"])

    for b in slices(batches, TEXTS):
        held.append(split_words(b.column("text"))[0].cast(pa.binary()))
        if sum(w.nbytes for w in held) > HELD_BYTES:
            yield flush()
    yield flush()


def train(rows: DataFrame, folding: Folding, path: str, tokens: float) -> Attention:
    """On windows of all rows of (doc_id, text), by averaging over tasks. tokens: the subword ids of all rows.

    Texts are cut into parts of PART words. All are learnt from; with DRAWN below 1 each is drawn with the same chance, DRAWN,
    or more where that gives TASKS tasks fewer than STEPS batches. The windows of the parts are dealt over the rounds at
    random, so each round sees all parts of the corpus. In a round, tasks go on from one model, each with its windows of the
    round; the mean of their models and of Adam's moments, by windows, begins the next round. With the corpus grow the
    batches, from BATCH to WIDE windows, and then the tasks of a round, STEPS batches each in all; where it has too few
    windows, they are taken repeatedly."""
    if not tokens:
        return Attention(used=folding.used)
    start, spark = int(folding.class_of[subwords(path).end]), rows.sparkSession
    in_all = tokens / SCORED
    share = min(1.0, max(DRAWN, STEPS * TASKS * BATCH / in_all))
    batch = int(min(WIDE, max(BATCH, in_all * share / STEPS / TASKS)))
    tasks, rounds = max(TASKS, round(in_all * share / STEPS / batch)), ROUNDS
    least = STEPS // rounds  # of a task in a round

    def deal(batches):
        r, sub = np.random.default_rng(TaskContext.get().partitionId()), subwords(path)
        for b in slices(batches, TEXTS):
            _, numbers, ids, begins, at = sub.code_texts(b.column("text"))
            place = np.arange(len(numbers)) - np.repeat(at[:-1], np.diff(at))
            parts = np.flatnonzero(place % PART == 0)  # their first words; an end is in the part after the last whole one
            tokens = np.append(begins[parts], begins[-1])
            sizes, before, classes = np.diff(tokens), np.where(place[parts] == 0, start, folding.pad), folding.class_of[ids]
            if share < 1:
                drawn = r.random(len(parts)) < share
                classes, sizes, before = classes[np.repeat(drawn, sizes)], sizes[drawn], before[drawn]
            got, _ = all_spans(classes, sizes, before, folding.pad, r.permutation)
            first = int(r.integers(rounds))  # of the rounds, for the windows that don't go round evenly
            dealt = [(k, g.tobytes()) for k in range(rounds) if len(g := got[(k - first) % rounds :: rounds])]
            yield pa.RecordBatch.from_pydict({"spans": pa.array([g for _, g in dealt], pa.binary()), "turn": pa.array([k for k, _ in dealt], pa.int32())})

    dealt = durable(rows.select("text").mapInArrow(deal, "spans binary, turn int"), "lm-spans", "turn")

    def go_on(shared, turn):
        def run(batches):
            got = [np.frombuffer(s, np.int16) for b in batches for s in b.column("spans").to_pylist()]
            if got:
                x, y = unspan(np.concatenate(got).reshape(-1, OVERLAP + SCORED + 1), folding.pad)
                model = Attention(used=folding.used).load(np.frombuffer(shared.value, np.float32))
                model.train(x, y, max(least, -(-len(x) // batch)), TaskContext.get().partitionId() * rounds + turn, turn, rounds, batch)
                yield _state(len(x), model.state())

        return run

    model, kind = Attention(used=folding.used), "n long, state binary"
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(model.state().tobytes())
        out = dealt.filter(F.col("turn") == turn).select("spans").repartition(tasks).mapInArrow(go_on(shared, turn), kind)
        if tasks > 32:  # means of means, so that the driver isn't sent every task's model
            out = out.repartition(int(tasks**0.5)).mapInArrow(_mean, kind)
        for b in _mean(out.toArrow().to_batches()):
            model.load(np.frombuffer(b.column("state")[0].as_py(), np.float32))
        shared.destroy()
    return model


def _state(n: int, state: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "state": pa.array([state.astype(np.float32).tobytes()], pa.binary())})


def _mean(batches):
    total, n = 0.0, 0
    for b in batches:
        for k, state in zip(b.column("n").to_pylist(), b.column("state").to_pylist()):
            total, n = total + k * np.frombuffer(state, np.float32).astype(float), n + k
    if n:
        yield _state(n, total / n)


def _score(shared, path: str):
    """A row for each text, and one for each occurrence of a word that isn't common (with `word`)."""

    def run(batches):
        run, common, counts, weights, ends, total, folding, model = shared.value
        sub = with_common(path, common, run)
        start = int(folding.class_of[sub.end])
        uid = TaskContext.get().partitionId() << 40
        shares, logs = weights.shares(counts), np.log10(counts + 0.1)
        end_log, end_known = float(np.log10(ends + 0.1)), int(ends > 0)
        none = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())]
        for b in slices(batches, TEXTS):
            words, numbers, ids, begins, at = sub.code_texts(b.column("text"))
            tokens = begins[at]  # where the texts' ids begin
            sizes = np.diff(tokens)
            rows, first = all_spans(folding.class_of[ids], sizes, np.full(len(sizes), start), folding.pad)
            lp, opens = (a.ravel() for a in model.log_probs(*unspan(rows, folding.pad), folding.first))
            there = np.arange(len(ids)) + np.repeat(first * SCORED - tokens[:-1], sizes)
            ended = numbers == sub.end_number
            lp = by_word(lp[there] + folding.log_in[ids], opens[there], begins[:-1], ended)
            on, rare = numbers < len(common), np.flatnonzero(numbers > sub.end_number)
            known, base, score = np.zeros((3, len(numbers)))
            j = numbers[on]
            known[on], base[on], score[on] = 1, logs[j], np.log10(shares[j] + weights.rest * np.exp(lp[on]))  # common words have shares above 0
            known[ended], base[ended], score[ended] = end_known, end_log, weights.mixed(ends, lp[ended])
            known, base, score = (np.add.reduceat(a, at[:-1]) for a in (known, base, score))
            uids = uid + 1 + np.arange(len(sizes))
            uid += len(sizes)
            text = np.repeat(np.arange(len(sizes)), np.diff(at))[rare]
            n, t = len(sizes), len(rare)
            yield pa.RecordBatch.from_pydict({
                "uid": pa.array(uids), "doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "n_tokens": pa.array(np.diff(at)),
                "known": pa.array(known.astype(np.int64)), "base": pa.array(base), "score": pa.array(score), "word": pa.nulls(n, pa.binary()), "lp": pa.nulls(n, pa.float32()),
            })
            yield pa.RecordBatch.from_pydict({"uid": pa.array(uids[text])} | {k: pa.nulls(t, v) for k, v in none} | {"word": words.take(pa.array(rare - text)).cast(pa.binary()), "lp": pa.array(lp[rare].astype(np.float32))})

    return run


def by_word(per_id: np.ndarray, opens: np.ndarray, begins: np.ndarray, ended: np.ndarray) -> np.ndarray:
    """log p of each word and end of texts, one after the other: of its ids, given that its first one begins a word, and,
    but for ends, that another begins after it. opens: at each id's place, log p that a word or the end begins there;
    begins: of each word, the place of its first id."""
    out = np.add.reduceat(per_id, begins) - opens[begins]
    inside = np.flatnonzero(~ended)
    out[inside] += opens[begins[inside + 1]]
    return out


class Weights:
    """counts: total number of learning tokens, of distinct ones, and of those that stand once and twice."""

    def __init__(self, total: float, distinct: float, once: float, twice: float):
        self.total = max(1.0, total)
        self.discount = once / (once + 2 * twice) if once and twice else 0.5
        self.seen = SEEN if total else 0.0
        self.rest = 1 - self.seen * (1 - self.discount * distinct / self.total)

    def mixed(self, c: np.ndarray, lp: np.ndarray) -> np.ndarray:
        """log10 p; c: counts in the learning texts, lp: natural log of the model's p."""
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(self.shares(c)), np.log(self.rest) + lp) / LN10

    def shares(self, c: np.ndarray) -> np.ndarray:
        return self.seen * np.maximum(0, c - self.discount) / self.total

    def column(self, c, lp):
        held = F.when(c > 0, self.seen * (c - self.discount) / self.total).otherwise(0.0)
        return F.when(held == 0, (lp + float(np.log(self.rest))) / LN10).otherwise(F.log10(held + self.rest * F.exp(lp)))


def score_texts(docs: DataFrame, modulus: int = 10, remainder: int = 0, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null text is empty: its one token is the end. A null id isn't held out. Repeated rows count and score as often as
    they stand there. Without learning texts nothing is known and the model is untrained. An empty table gives an empty
    result. A very long text or word is scored whole; other columns of docs are not read."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    rows = key_rows(docs, id_col, text_col).withColumn("held_out", held_out("doc_id", modulus, remainder))
    learn = rows.filter("not held_out")
    counts = durable(learn.select("text").mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")), "word-counts")
    ends = learn.count()
    short = F.length("word") <= COMMON_BYTES
    got = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
    total, distinct, once, twice = got[0] + ends, got[1] + (ends > 0), got[2] + (ends == 1), got[3] + (ends == 2)
    weights = Weights(total, distinct, once, twice)
    scale = F.floor(F.log2("c") * 4)  # quarters of a doubling: the commonest words are those of the highest steps that fit
    at_step, least, held = dict(map(tuple, counts.filter(short).groupBy(scale.alias("step")).count().collect())), None, 0
    for step in sorted(at_step, reverse=True):
        held += at_step[step]
        if held > COMMON_WORDS:
            break
        least = step
    common = counts.filter(short & (scale >= least) if least is not None else F.lit(False)).toArrow()

    def fold(batches):
        sub = Subwords(path)
        sums = np.zeros(sub.n_ids)
        for b in batches:
            for i in range(0, len(b), 5_000):
                part = b.slice(i, 5_000)
                _, ids, begins = sub.code([part.column("word").to_pylist()])[0]
                sums += np.bincount(ids[:-1], np.repeat(part.column("c").to_numpy(), np.diff(begins)), sub.n_ids)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"id": pa.array(some, pa.int32()), "n": pa.array(sums[some], pa.float64())})

    ids = np.zeros(subwords(path).n_ids)
    for k, n in counts.mapInArrow(fold, "id int, n double").groupBy("id").agg(F.sum("n")).collect():  # an id a row
        ids[k] = n
    ids[subwords(path).end] = ends
    folding = Folding(ids, subwords(path).begins)
    model = train(learn, folding, path, float(ids.sum()))
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, common["word"].to_pylist(), common["c"].to_numpy().astype(float), weights, float(ends), float(max(1, total)), folding, model))
    scored = durable(rows.select("doc_id", "held_out", "text").mapInArrow(_score(shared, path), "uid long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, word binary, lp float"), "lm-scores")
    c, lp = F.coalesce("c", F.lit(0)), F.col("lp").cast("double")
    mix = weights.column(c, lp)
    rare = (
        scored.filter("word is not null").select("uid", "word", "lp").join(counts, "word", "left")
        .groupBy("uid").agg(F.count_if(c > 0).alias("known2"), F.sum(F.log10(c + 0.1)).alias("base2"), F.sum(mix).alias("score2"))
    )
    norm = float(np.log10(total + 0.1 * (distinct + 1)))
    return scored.filter("word is null").drop("word", "lp").join(rare, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("known2", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", F.lit(0.0)) - F.col("n_tokens") * norm).alias("base_score"), (F.col("score") + F.coalesce("score2", F.lit(0.0))).alias("score"),
    )


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
