"""Rule tables, keyword automata, imperfect answers and the durable map executor."""

from __future__ import annotations

import os
import random
import re

import pytest

from quire.functions.keywords import keyword_places
from quire.plans import executor, review


def test_first_matching_rule_decides(spark):
    """Two rules match some values: the smaller order decides, rules for all among them."""
    rules = [("card", 2, "^4", "second"), ("card", 1, "42", "first"), (None, 3, "9$", "for all"), ("card", 2, "^40", "tie"), (None, 0, None, "never"), ("mail", 9, "@", None)]
    values = [(1, "card", "4200"), (2, "card", "4100"), (3, "card", "4009"), (4, "mail", "a@9"), (5, None, "x9"), (6, "card", None), (7, "other", "1"), (8, "card", "19")]
    df = spark.createDataFrame(values, "id int, category string, value_example string")
    table = spark.createDataFrame(rules, "category string, order int, pattern string, verdict string")
    want = {1: "first", 2: "second", 3: "second", 4: "for all", 5: "for all", 6: "LOW", 7: "LOW", 8: "for all"}
    for most in (1000, 1):
        got = review.by_rules(df, table, most=most)
        assert got.columns == [*df.columns, "verdict"]
        assert {r.id: r.verdict for r in got.collect()} == want
    assert {r.verdict for r in review.by_rules(df, table.where("false"), "none").collect()} == {"none"}


@pytest.mark.parametrize("most", [1_000_000, 40])
def test_keywords_equal_a_plain_search(spark, most):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(1, 5))) for _ in range(60)})
    texts = [(k, None if k == 4 else "".join(rng.choice("abéÉ  ") for _ in range(rng.randrange(60)))) for k in range(80)]
    df = spark.createDataFrame(texts, "id int, content string").repartition(3)
    known = spark.createDataFrame([(f"k{len(w) % 2}", w) for w in words] + [("k9", words[0]), ("k9", words[0]), ("x", ""), ("x", None)], "kind string, word string")
    got = sorted(map(tuple, keyword_places(df, known, most=most).collect()))
    plain = [(i, f"k{len(w) % 2}", w, m.start()) for i, t in texts for w in words for m in re.finditer(f"(?={w})", t or "")]
    plain += [(i, "k9", w, at) for i, _, w, at in plain if w == words[0]]
    assert got == sorted(plain)
    whole = keyword_places(df, known.where("kind <> 'k9'"), boundary=" ", lower=True, most=most)
    want = [(i, f"k{len(w) % 2}", w, m.start()) for i, t in texts for w in words for m in re.finditer(f"(?<![^ ]){w}(?![^ ])", (t or "").lower())]
    assert sorted(map(tuple, whole.collect())) == sorted(want)


def test_no_keywords(spark):
    df = spark.createDataFrame([(1, "text")], "id int, content string")
    assert keyword_places(df, spark.createDataFrame([], "kind string, word string")).count() == 0
    assert keyword_places(df.where("false"), spark.createDataFrame([("a", "text")], "kind string, word string")).count() == 0


ANSWERS = [
    (1, '[{"category":"a","pos":1},{"category":"b","pos":"7","evidence":"x {y}"}]'),
    (2, '[{"category":"a","pos":1},{"category":"b","attributes":{"k":"v}"}},{"category":"cut", "po'),
    (3, '```json\n[{"category":"a","pos":"many"},{"category":"q\\"}","pos":3},5,{"pos":4}]\n``` done'),
    (4, "[]"),
    (5, "nothing found"),
    (6, None),
    (7, '{"category":"one","pos":null}'),
    (8, ""),
    (9, '[[{"category":"nested"}]]'),
]


def test_imperfect_answers(spark):
    """A cut-off array and wrong elements cost only themselves."""
    df = spark.createDataFrame(ANSWERS, "id int, answer string")
    good, left = review.salvaged(df, {"category": "string", "pos": "int", "attributes": "map<string,string>"}, ["category"])
    assert sorted((r.id, r.k, r.category, r.pos, r.attributes) for r in good.collect()) == [
        (1, 0, "a", 1, None), (1, 1, "b", 7, None), (2, 0, "a", 1, None), (2, 1, "b", None, {"k": "v}"}), (3, 1, 'q"}', 3, None), (7, 0, "one", None, None),
    ]
    rejects = sorted((r.id, r.k, r.reason) for r in left.collect())
    assert rejects == [(2, 2, "no whole element"), (3, 0, "another type of pos"), (3, 2, "lacks category"), (3, 3, "no whole element"), (5, 0, "no whole element"), (9, 0, "not an object")]


def test_long_answers(spark):
    """Answers of many elements, whole or cut, keep every whole element."""
    many = "[" + ",".join(f'{{"category":"c{k}","pos":{k},"evidence":"some \\"text\\" {{{k}"}}' for k in range(2000))
    df = spark.createDataFrame([(1, many + "]"), (2, many + ',{"category')], "id int, answer string")
    good, left = review.salvaged(df, {"category": "string", "pos": "int"}, ["category"])
    assert [r["count"] for r in good.groupBy("id").count().orderBy("id").collect()] == [2000, 2000]
    assert [(r.id, r.text) for r in left.collect()] == [(2, '{"category')]


def detector(log, dies=0, fails=()):
    """Counts its calls in files; its process dies once, after ``dies`` of them."""

    def call(check: str, text: str) -> str:
        import uuid

        with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
            f.write(f"{check}|{text}")
        if text in fails:
            raise ValueError(f"no answer to {text}")
        if dies and len(os.listdir(log)) > dies and not os.path.exists(f"{log}.died"):
            open(f"{log}.died", "w").close()
            raise SystemExit(3)  # not an error of the detector: the task fails and Spark runs it again
        return f"{check}:{len(text)}"

    return call


def calls(log):
    return sorted(open(f"{log}/{n}").read() for n in os.listdir(log))


def tasks_of(spark, n):
    rows = [(k, "PII" if k % 2 else "KNOWLEDGE", f"text {k % 10}") for k in range(n)]
    return spark.createDataFrame([*rows, (99, "PII", None)], "id int, check_type string, text string")


def test_equal_tasks_are_called_once(spark, tmp_path):
    log, store = tmp_path / "log", f"file://{tmp_path}/store"
    log.mkdir()
    got = executor.run_tasks(tasks_of(spark, 40), detector(str(log)), store, buckets=4).collect()
    assert len(got) == 41
    assert {(r.check_type, r.text or "", r.answer) for r in got} == {(r.check_type, r.text or "", f"{r.check_type}:{len(r.text or '')}") for r in got}
    assert len(calls(log)) == 11
    executor.run_tasks(tasks_of(spark, 40), detector(str(log)), store, buckets=4, calls_per_file=5).collect()
    assert len(calls(log)) == 11  # all known
    assert executor.run_tasks(tasks_of(spark, 40).where("false"), detector(str(log)), store).count() == 0


def test_failures_are_rows_and_tried_again(spark, tmp_path):
    log, store = tmp_path / "log", f"file://{tmp_path}/store"
    log.mkdir()
    got = executor.run_tasks(tasks_of(spark, 10), detector(str(log), fails=("text 3", "text 4")), store, buckets=3, retries=1).collect()
    assert {(r.text, r.answer, r.error, r.tries) for r in got if r.error} == {(t, None, f"ValueError: no answer to {t}", 2) for t in ("text 3", "text 4")}
    before = len(calls(log))
    again = executor.run_tasks(tasks_of(spark, 10), detector(str(log)), store, buckets=3).collect()
    assert all(r.answer and not r.error for r in again)
    assert len(calls(log)) == before + 2


def test_a_lost_task_calls_nothing_twice(spark, tmp_path):
    """The worker dies in the middle; what it had been answered is not asked again, by the store's next run."""
    log, store = str(tmp_path / "log"), f"file://{tmp_path}/store"
    os.mkdir(log)
    tasks = tasks_of(spark, 10)
    try:
        executor.run_tasks(tasks, detector(log, dies=4), store, buckets=2).collect()
    except Exception as e:  # a local session does not run a task again
        assert "SystemExit" in str(e) or "exited" in str(e) or "Python worker" in str(e)
    got = executor.run_tasks(tasks, detector(log, dies=4), store, buckets=2).collect()
    assert os.path.exists(f"{log}.died") and all(r.answer for r in got)
    asked = calls(log)
    assert len(set(asked)) == 11
    assert len(asked) <= 12  # only the call during which it died comes again


def test_rounds_bound_what_a_task_reads(spark, tmp_path, monkeypatch):
    """Much text is dealt in rounds: every task is answered, once, and no task of a bucket gets all of it."""
    seen = []
    work = executor._bucket_work
    monkeypatch.setattr(executor, "_bucket_work", lambda *a: seen.append(a) or work(*a))
    monkeypatch.setattr(executor, "ROUND_BYTES", 20)
    log = tmp_path / "log"
    log.mkdir()
    got = executor.run_tasks(tasks_of(spark, 40), detector(str(log)), f"file://{tmp_path}/store", buckets=2).collect()
    assert len(seen) > 3
    assert all(r.answer is not None for r in got)
    assert len(list(log.iterdir())) == len({r.task_key for r in got})


def test_places_of_a_long_text_take_no_copies_of_it(spark):
    """What comes out of a text is passed on in parts, and the text itself is not repeated for each place."""
    import pyarrow as pa

    from quire.functions import keywords

    work = keywords._finder({"ab": ["k"]}, None, False, ["id", "kind", "word", "at"])
    text = "ab " * 30_000
    before = pa.total_allocated_bytes()
    sizes = []
    for part in work(iter([pa.RecordBatch.from_pydict({"id": [7], "content": [text]})])):
        sizes.append(part.num_rows)
        assert pa.total_allocated_bytes() - before < 10_000_000
    assert sizes == [20_000, 10_000]
