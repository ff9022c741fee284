"""Toxicity by a weighted finite-state grammar of clauses.

Words are read as symbols: insult, threat, target, negation, report.  Small
transducers rewrite the symbols in turn: reported speech and negation mark
what stands in their scope, an insult or a threat that meets a target in its
clause becomes a directed one, and the last transducer puts out, at the end
of a clause, the gravest thing that the clause holds.  They are composed into
one machine.  The score of a document is a logistic function of how many
clauses of each type it has, so a word counts for what its clause makes of it.

Insults are a list of fixed words and those that a bounded sample of labelled
documents shows: words, and beginnings of words, that are common in toxic
documents and next to absent from others.  The weights start from fixed
values and are fitted on the half of the sample that a lexicon has not seen.  Neither doc_id, lang nor source is
an input.

Defined cases: null and empty texts have no clause and get the least score;
without labelled rows the fixed words and weights stand alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekwise.llm.common import Scratch, held_out
from weekwise.llm.labelled import FIT_ROWS, labelled_sample
from weekwise.llm.text_arrays import Words, alnum_words, chunks

# Words by symbol, in four languages.
SEEDS = {
    "insult": """idiot idiots moron morons stupid loser losers scum trash worthless pathetic disgusting clown imbecile
        dumbass bastard idiotisch trottel abschaum versager dummkopf arschloch vollidiot idiote idiotes imbécile crétin
        abruti ordure connard idiota idiotas imbécil estúpido estúpida escoria inútil""",
    "threat": """kill murder hurt destroy beat stab shoot strangle umbringen töten erschießen verprügeln tuer tuerai
        frapper égorger matar mataré matarte golpear degollar""",
    "target": """you your yourself he she him they them du dich dir ihr euch sie tu toi vous il elle ils te usted
        ustedes él ella ellos ti""",
    "negation": "not never no nobody isn aren don nicht kein keine niemals nie pas jamais ne nunca jamás tampoco",
    "report": """said says called wrote quoted alleged claimed reportedly sagte nannte schrieb zitierte angeblich dit
        écrit appelé cité dijo llamó escribió citó""",
}
SYMBOLS = ["report", "negation", "target", "threat", "insult"]
# Clause types from the least grave to the gravest, with weights to start from.
START = {"reported": 0.5, "negated": 0.7, "threat": 1.5, "insult": 2.5, "directed": 3.0, "menace": 3.0}
START_BIAS = -3.5
THRESHOLD = 0.3
HEADS = (4, 5, 6)        # bytes of word beginnings that may be insults
# A learned word occurs in so many toxic documents of the sample, in so large a
# share of them, and its share in clean ones is at most so large a part of that.
WORD_RULE = (4, 0.004, 0.02)
HEAD_RULE = (8, 0.02, 0.005)
MOST_WORDS = 20_000      # entries a model learns at most, the most frequent ones


class Transducer:
    """A deterministic machine: (state, symbol) -> (state, symbol put out).

    A symbol without a rule passes unchanged and leaves the state.
    """

    def __init__(self, start: str, rules: dict[tuple[str, str], tuple[str, str]]) -> None:
        self.start, self.rules = start, rules

    def step(self, state, symbol):
        return self.rules.get((state, symbol), (state, symbol))


class Composed(Transducer):
    """``first``, whose output is what ``then`` reads."""

    def __init__(self, first: Transducer, then: Transducer) -> None:
        super().__init__((first.start, then.start), {})
        self.first, self.then = first, then

    def step(self, state, symbol):
        known = self.rules.get((state, symbol))
        if known is None:
            a, between = self.first.step(state[0], symbol)
            b, out = self.then.step(state[1], between)
            known = self.rules[state, symbol] = ((a, b), out)
        return known


def grammar() -> Transducer:
    """Reported speech, negation, target and clause, composed."""
    reported = Transducer("free", {
        ("free", "report"): ("told", "report"), ("told", "end"): ("free", "end"),
        ("told", "insult"): ("told", "reported"), ("told", "threat"): ("told", "reported")})
    negated = Transducer("plain", {
        ("plain", "negation"): ("denied", "negation"), ("denied", "end"): ("plain", "end"),
        ("denied", "insult"): ("denied", "negated"), ("denied", "threat"): ("denied", "negated")})
    # an insult and a target of one clause meet in either order, so does a threat
    target = Transducer("none", {
        ("none", "target"): ("target", "target"), ("target", "end"): ("none", "end"),
        ("target", "insult"): ("target", "directed"), ("target", "threat"): ("target", "menace"),
        ("none", "insult"): ("insult", "insult"), ("none", "threat"): ("threat", "threat"),
        ("insult", "target"): ("target", "directed"), ("threat", "target"): ("target", "menace"),
        ("insult", "threat"): ("threat", "threat"), ("threat", "insult"): ("threat", "insult"),
        ("insult", "end"): ("none", "end"), ("threat", "end"): ("none", "end")})
    grave = ["clean", *START]
    clause = Transducer("clean", {
        (now, seen): (max(now, seen, key=grave.index), "")
        for now in grave for seen in START} | {(now, "end"): ("clean", now) for now in grave})
    return Composed(Composed(Composed(reported, negated), target), clause)


TYPES = list(START)
_GRAMMAR = grammar()


def clause_types(symbols: list[str]) -> np.ndarray:
    """How many clauses of each type a sequence of symbols and ends has."""
    counts = np.zeros(len(TYPES))
    state = _GRAMMAR.start
    for symbol in [*symbols, "end"]:
        state, out = _GRAMMAR.step(state, symbol)
        if symbol == "end" and out != "clean":
            counts[TYPES.index(out)] += 1
    return counts


class Lexicon:
    """Hashes of words and word beginnings, by symbol."""

    def __init__(self, learned: dict[int, list[int]]) -> None:
        words: dict[int, int] = {}
        for k, name in enumerate(SYMBOLS):
            spelled = Words(pa.array([SEEDS[name]], pa.large_string()), alnum_words())
            words.update(dict.fromkeys(spelled.hashes.tolist(), k))
        insult = SYMBOLS.index("insult")
        words.update(dict.fromkeys(learned.get(0, []), insult))
        self.words = words
        self.keys = np.array(sorted(words), dtype=np.uint64)
        self.symbols = np.array([words[k] for k in self.keys.tolist()], dtype=np.int8)
        self.heads = {k: np.array(sorted(v), dtype=np.uint64) for k, v in learned.items() if k and v}

    def read(self, words: Words) -> np.ndarray:
        """The symbol of every word, -1 for none."""
        out = np.full(len(words.starts), -1, dtype=np.int8)
        at = np.minimum(np.searchsorted(self.keys, words.hashes), len(self.keys) - 1)
        hit = self.keys[at] == words.hashes
        out[hit] = self.symbols[at[hit]]
        insult = SYMBOLS.index("insult")
        for length, keys in self.heads.items():
            long, heads = words.heads(length)
            at = np.minimum(np.searchsorted(keys, heads), len(keys) - 1)
            out[long[keys[at] == heads]] = insult
        return out


_END = np.zeros(256, dtype=bool)
_END[[ord(c) for c in ".!?;\n"]] = True


def clause_counts(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """Clause types of every text; whole texts, but only around insults and threats is anything to do."""
    words = Words(texts, alnum_words())
    symbols = lexicon.read(words)
    out = np.zeros((len(texts), len(TYPES)))
    marked = np.flatnonzero(symbols >= 0)
    clause = np.searchsorted(np.flatnonzero(_END[words.buf]), words.starts[marked])
    doc = np.searchsorted(words.word_offs, marked, "right") - 1
    grave = symbols[marked] >= SYMBOLS.index("threat")
    # clauses without an insult or a threat put nothing out
    place = doc.astype(np.int64) << np.int64(32) | clause
    kept = np.isin(place, np.unique(place[grave]))
    marked, place, doc = marked[kept], place[kept], doc[kept]
    bounds = np.flatnonzero(np.diff(place, prepend=-1)).tolist() + [len(place)]
    names = [SYMBOLS[s] for s in symbols[marked].tolist()]
    for a, b in zip(bounds[:-1], bounds[1:]):
        out[doc[a]] += clause_types(names[a:b])
    return out


def learn_insults(sample: DataFrame) -> dict[int, list[int]]:
    """Hashes of insults by head length, 0 for whole words, from (text, label)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            words = Words(batch.column("text"), alnum_words())
            label = np.array(batch.column("label").to_pylist(), dtype=np.int64)
            doc = np.searchsorted(words.word_offs, np.arange(len(words.starts)), "right") - 1
            for length in (0, *HEADS):
                at, hashes = (np.arange(len(words.starts)), words.hashes) if not length else words.heads(length)
                order = np.lexsort((doc[at], hashes))
                h, d = hashes[order], doc[at][order]
                once = np.ones(len(h), dtype=bool)
                once[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                keys, first = np.unique(h[once], return_index=True)
                toxic = np.add.reduceat(label[d[once]], first) if len(first) else first
                n = np.diff(np.append(first, once.sum()))
                yield pa.RecordBatch.from_pydict({
                    "length": pa.array(np.full(len(keys), length), pa.int32()),
                    "hash": pa.array(keys.view(np.int64), pa.int64()),
                    "toxic": pa.array(toxic, pa.int64()), "clean": pa.array(n - toxic, pa.int64())})

    rows = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not rows.get(1):
        return {}
    n_toxic, n_clean = rows[1], rows.get(0, 0) + 1
    counts = (sample.mapInArrow(run, "length int, hash long, toxic long, clean long")
              .groupBy("length", "hash").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))

    def passes(rule):
        support, share, clean = rule
        return ((F.col("toxic") >= max(support, share * n_toxic))
                & (F.col("clean") / n_clean <= clean * F.col("toxic") / n_toxic))

    found = counts.filter(F.when(F.col("length") == 0, passes(WORD_RULE)).otherwise(passes(HEAD_RULE)))
    out: dict[int, list[int]] = {}
    for r in found.orderBy(F.desc("toxic"), "length", "hash").limit(MOST_WORDS).collect():
        out.setdefault(r["length"], []).append(r["hash"] & (2**64 - 1))
    return out


def _inputs(counts: np.ndarray) -> np.ndarray:
    """A document is no more toxic for its sixth clause of a type."""
    return np.minimum(counts, 5)


def fit_weights(x: np.ndarray, y: np.ndarray, weight: np.ndarray, pull: float = 1.0, steps: int = 50) -> np.ndarray:
    """Logistic weights, bias last, by Newton's method, drawn to the fixed ones."""
    start = np.array([*START.values(), START_BIAS])
    x = np.column_stack([x, np.ones(len(x))])
    w = start.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + pull * (w - start)
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        move = np.linalg.solve(hessian, gradient)
        w = w - np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-6:
            break
    return w


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray) -> None:
        self.lexicon, self.weights = lexicon, weights

    def score(self, texts: pa.Array) -> np.ndarray:
        x = _inputs(clause_counts(texts, self.lexicon))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Lexicon and weights from at most ``rows`` documents of each label."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample, weight = labelled_sample(docs, labels, "toxic", scratch, rows)
    x, y = [np.zeros((0, len(TYPES)))], [np.zeros(0)]
    for fold in (0, 1):  # weights come from documents that the lexicon has not seen
        lexicon = Lexicon(learn_insults(sample.filter(F.col("fold") % 2 != fold)))
        shared = docs.sparkSession.sparkContext.broadcast(lexicon)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches, "text"):
                counts = clause_counts(batch.column("text"), shared.value)
                yield pa.RecordBatch.from_pydict({"counts": pa.array(list(counts), pa.list_(pa.float64())),
                                                  "label": batch.column("label"), "gram": batch.column("gram")})

        # one short row for each document of the sample, in an order of its own
        found = sample.filter(F.col("fold") % 2 == fold).mapInArrow(
            run, "counts array<double>, label int, gram long").orderBy("gram", "label").collect()
        x.append(np.array([r["counts"] for r in found]).reshape(len(found), len(TYPES)))
        y.append(np.array([r["label"] for r in found], dtype=float))
    y = np.concatenate(y)
    row_weight = np.where(y > 0, weight.get(1, 1.0), weight.get(0, 1.0))
    weights = fit_weights(_inputs(np.concatenate(x)), y, row_weight)
    model = Model(Lexicon(learn_insults(sample)), weights)
    scratch.clear()
    return model


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"),
                                              "score": pa.array(shared.value.score(batch.column("text")))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every text."""
    scored = score_documents(docs, fit(docs, labels, rows))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, in its columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            yield batch.filter(pa.array(shared.value.score(batch.column("text")) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
