import numpy as np
from llm_helpers import documents, edge_rows, importable
from pyspark.sql import functions as F

from weekwise.llm import toxicity as tox
from weekwise.llm.common import held_out

SF = "/root/testdata/sf0.1"


def types(text):
    import pyarrow as pa
    found = tox.clause_counts(pa.array([text]), tox.Lexicon({}))[0]
    return {t: int(n) for t, n in zip(tox.TYPES, found) if n}


def test_clauses():
    assert types("You are an idiot.") == {"directed": 1}
    assert types("What an idiot! you said nothing.") == {"insult": 1}
    assert types("You are not an idiot.") == {"negated": 1}
    assert types("She said he is an idiot. The idiot left.") == {"reported": 1, "insult": 1}
    assert types("I will kill you; kill time.") == {"menace": 1, "threat": 1}
    assert types("An idiot, that is you") == {"directed": 1}
    assert types("Nothing here. At all!") == {}
    assert types(None) == {} and types("") == {}


def test_composition_equals_running_in_turn():
    first = tox.Transducer("a", {("a", "x"): ("b", "y"), ("b", "x"): ("a", "z")})
    then = tox.Transducer("c", {("c", "y"): ("d", "1"), ("d", "z"): ("c", "2")})
    both = tox.Composed(first, then)
    state, s1, s2 = both.start, first.start, then.start
    for symbol in "xxwxxxyx":
        state, out = both.step(state, symbol)
        s1, between = first.step(s1, symbol)
        s2, expected = then.step(s2, between)
        assert out == expected


def test_weights_follow_the_labels():
    x = np.repeat(np.eye(len(tox.TYPES)), 50, axis=0)
    y = (np.arange(len(x)) // 50 >= 3).astype(float)
    w = tox.fit_weights(np.vstack([x, np.zeros((50, x.shape[1]))]), np.append(y, np.zeros(50)), np.ones(len(x) + 50))
    assert min(w[3:6]) > max(w[:3])


def test_edges_and_no_labels(spark):
    none = importable(spark).createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents(spark, edge_rows() + [(900, "You stupid idiot. You moron!")])
    out = {r.doc_id: r for r in tox.toxicity(docs, none).collect() if r.doc_id is not None}
    assert out[900].predicted == 1 and out[1].predicted == out[2].predicted == 0
    assert out[1].score == out[2].score == min(r.score for r in out.values())
    assert tox.toxicity(documents(spark, []), none).collect() == []
    kept = tox.drop_toxic(docs, tox.fit(docs, none))
    assert kept.columns == docs.columns and kept.filter("doc_id = 900").count() == 0
    assert kept.count() == len(edge_rows())


def test_held_out_accuracy(spark):
    docs, labels = (importable(spark).read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = tox.toxicity(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    hit = sum(r.predicted == r.toxic for r in rows) / len(rows)
    found = [r.predicted for r in rows if r.toxic == 1]
    assert hit > 0.97 and sum(found) / len(found) > 0.9
    assert spark.range(1000).filter(held_out(F.col("id"))).count() in range(150, 350)
