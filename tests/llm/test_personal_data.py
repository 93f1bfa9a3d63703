import hashlib
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from duebook.llm import crf_tagger, personal_data
from duebook.llm.personal_data import Detector, base_spans, luhn, valid

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    keep = {
        "email": lambda m: True,
        "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda m: 13 <= len(re.sub(r"[^0-9]", "", m)) <= 19 and luhn(re.sub(r"[^0-9]", "", m)),
        "phone": lambda m: 9 <= len(re.sub(r"[^0-9]", "", m)) <= 15,
    }
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if keep[k](m.group())]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="ab1.2@-+ ()%é\n0", max_size=60))
def test_rules_equal_the_patterns(text):
    assert base_spans(text) == plain(text)


def test_rules_on_whole_items_and_long_runs():
    assert base_spans("4111 1111 1111 1111") == [("card", 0, 19)]
    assert base_spans("4111111111111112") == []
    assert base_spans("1.2.3.256 and 001.2.3.4") == plain("1.2.3.256 and 001.2.3.4")
    assert base_spans("1" * 200_000) == [] and base_spans("a" * 200_000 + "@") == []
    assert not valid("card", "4111111111111112") and luhn("4111111111111111")


def test_gradients_are_right():
    tagger = crf_tagger.Tagger.fresh(2, 3, 1)
    tagger.weights = {k: v.astype(np.float64) for k, v in tagger.weights.items()}
    rng = np.random.default_rng(0)
    x, gold = rng.integers(1, 20, (3, 6)), np.zeros((3, 6), int)
    x[0, 4:] = crf_tagger.PAD
    gold[1, 2], gold[1, 3], gold[2, 0] = 1, 2, 3
    _, grads = tagger.gradients(x, gold)
    for name, grad in grads.items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        w, old, losses = tagger.weights[name], tagger.weights[name][at], []
        for step in (1e-4, -1e-4):
            w[at] = old + step
            losses.append(tagger.gradients(x, gold)[0])
        w[at] = old
        assert abs((losses[0] - losses[1]) / 2e-4 - grad[at]) < 1e-3 * max(1, abs(grad[at]))


def _corpus(spark, n=900):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(n):
        w = [f"word{x}" if x % 9 else "in" for x in rng.integers(0, 50, 30)]
        digits = [int(x) for x in rng.integers(0, 10, 15)]
        digits[0] = 4
        card = next(c for d in range(10) if luhn(c := "".join(map(str, digits)) + str(d)))
        items = [
            f"nm{i % 37}.{i % 91}@mail{i % 9}.example.com", ".".join(str(x) for x in rng.integers(1, 256, 4)),
            card, f"+1 ({200 + i % 700}) 555-{1000 + i}",
        ]
        w[5] = items[i % 4]
        rows.append((i, " ".join(w).replace("word", "wo")))
    rows[0] = (0, "see +1 (269) 555-3296 4524132264652876 there")
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(2)


def test_tagger_adds_what_the_rules_miss_and_spares_clean_texts(spark):
    docs = _corpus(spark)
    found = personal_data.detected(docs, Detector(sample=900, epochs=24)).select("row.*", "n_phone", "spans").collect()
    by_id = {r.doc_id: r for r in found}
    assert by_id[0].n_phone == 0 and "phone:4:21" in by_id[0].spans
    extra = 0
    for r in found:
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(r.text))
        extra += r.doc_id != 0 and r.spans != base
    assert extra <= 4


def test_the_sample_has_every_kind_and_nothing_doubtful(spark):
    docs = _corpus(spark)
    rows = personal_data.training_windows(docs, Detector(sample=200)).collect()
    by_kind = {k: sum(r.kind == k for r in rows) for k in {r.kind for r in rows}}
    assert set(by_kind) == {*personal_data.KINDS, ""} and max(by_kind.values()) <= 40
    assert min(by_kind[k] for k in ("email", "ip", "phone", "")) == 40
    assert len({r.part for r in rows}) == len(rows)
    assert not any("+1 (269) 555-3296 4524132264652876" in r.part for r in rows)


def test_a_small_table_is_learnt_from_too(spark):
    docs = _corpus(spark).where("doc_id < 120")
    tagger = personal_data.trained(docs, Detector())
    texts = [f"call ({200 + i}) 555-{2000 + i} or mail some.name{i} @ host{i}.example.com" for i in range(40)]
    proposals = personal_data.tagged_spans(texts, tagger, Detector())
    found = {kind: sum(any(s[1] == kind for s in p) for p in proposals) for kind in ("phone", "email")}
    assert found["phone"] >= 30 and found["email"] >= 30


def test_edges(spark, documents, no_documents):
    found = personal_data.detected(documents, Detector(epochs=1)).collect()
    assert len(found) == documents.count()
    for r in found:
        base = base_spans(r["row"].text or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))
        assert (r.n_email, r.n_phone) == (text.count("email"), text.count("phone"))
    assert personal_data.detected(no_documents).isEmpty()
    redacted = personal_data.redacted(personal_data.detected(documents, Detector(epochs=1)))
    assert redacted.columns == documents.columns
    text = next(r.text for r in redacted.collect() if r.doc_id == 11)
    assert text.startswith("mail <EMAIL> or <PHONE> and <IP> now")


def test_overlapping_spans_are_redacted_once(spark):
    row = [("ab +1 269 555 4524132264 x", "card:6:24,phone:3:24")]
    df = spark.createDataFrame(row, "text string, spans string").selectExpr(
        "struct(text, cast(0 AS long) AS n_chars) AS row", "spans"
    )
    assert personal_data.redacted(df).first().text == "ab <PHONE> x"


def test_whole_texts_reach_python_in_small_batches(spark, documents):
    session = spark.newSession()
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = session.createDataFrame([(i, "call +1 (269) 555-3296") for i in range(4500)], documents.select("doc_id", "text").schema)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    found = personal_data.detected(docs.coalesce(1), Detector(epochs=1, least_steps=1))
    assert max(r.n for r in docs.coalesce(1).mapInArrow(sizes, "n long").collect()) <= 1000
    assert found.where("n_phone = 1").count() == 4500
    session.conf.set(name, "300")
    personal_data.detected(docs, Detector(epochs=1, least_steps=1))
    assert session.conf.get(name) == "300"
