"""The review beside its queries: specified keywords, model-backed detectors, merged places, report files."""

from __future__ import annotations

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.functions.detect import image_format
from quire.plans import review


@pytest.fixture(scope="module")
def elements(spark):
    rows = [
        (1, 0, "监管报送:客户覆盖率 口径明确, dataowner 张三"),
        (1, 1, "Mail ann@example.org or 13812345678901"),
        (2, 0, "Mail ann@example.org again, and ann@example.org"),
        (2, 1, "The customer_id is mandatory: format dd.mm.yyyy"),
        (3, 0, "客户标签 and 完整性 rules; the hit rate, no hitrate"),
    ]
    return spark.createDataFrame(rows, "doc_id long, position int, content string")


def test_specified_keywords(elements):
    assert [r.doc_id for r in elements.where(review.has_keyword(F.col("content"))).select("doc_id").distinct().collect()] == [1]


def test_specified_attributes(elements):
    found = {r.doc_id: r.missing for r in review.regulatory_findings(elements.where("position = 0"), ["doc_id"]).collect()}
    names = list(review.REPORT_ATTRIBUTES)
    stated = {n for k, n in enumerate(names) if not found[1] >> k & 1}
    assert stated == {"owner", "definition"}


def test_specified_knowledge(elements):
    got = {(r.category, r.name) for r in review.knowledge_findings(elements, ["doc_id"]).collect()}
    assert {("INDICATOR", "客户覆盖率"), ("INDICATOR", "hitrate"), ("TAG", "标签"), ("QUALITY_RULE", "完整性"), ("DATA_ITEM", "customer_id")} <= got


def test_places_keep_every_link(elements):
    found = review.personal_findings(elements, ["doc_id"])
    links = review.places(found, ["category", "value_example"], ["doc_id"]).where("category = 'e-mail'").orderBy("doc_id").collect()
    assert [(r.doc_id, r.pos, r.evidence[0][:4]) for r in links] == [(1, [1], "Mail"), (2, [0], "Mail")]
    whole = review.personal_overall(review.personal_by_document(found, ["doc_id"]), ["doc_id"]).where("category = 'e-mail'").first()
    assert (whole.documents, whole.places) == (2, 2)


def test_orders_and_lists(elements):
    regulatory = review.regulatory_overall(review.regulatory_findings(elements, ["doc_id"]), ["doc_id"])
    knowledge = review.knowledge_overall(review.knowledge_findings(elements, ["doc_id"]), ["doc_id"])
    personal = review.personal_overall(review.personal_by_document(review.personal_findings(elements, ["doc_id"]), ["doc_id"]), ["doc_id"])
    inputs = review.input_overall(review.input_findings(elements, ["doc_id"], F.lit("page")))
    tables = review.report_tables(personal, regulatory, inputs, knowledge)
    assert [n.rpartition("/")[2] for n in tables] == ["pii_findings", "regulatory_findings", "page_input_findings", "indicators", "tags", "data_items", "quality_rules"]
    ranks = [r.severity_rank for r in tables["findings/regulatory_findings"].collect()]
    assert ranks == sorted(ranks)
    missing = [r.n_missing for r in tables["findings/page_input_findings"].collect()]
    assert missing == sorted(missing, reverse=True)
    assert sum(rows.count() for name, rows in tables.items() if "knowledge" in name) == knowledge.count()


def test_report_files(spark, elements, tmp_path):
    personal = review.personal_overall(review.personal_by_document(review.personal_findings(elements, ["doc_id"]), ["doc_id"]), ["doc_id"])
    regulatory = review.regulatory_overall(review.regulatory_findings(elements, ["doc_id"]), ["doc_id"])
    inputs = review.input_overall(review.input_findings(elements, ["doc_id"], F.lit("page")))
    knowledge = review.knowledge_overall(review.knowledge_findings(elements, ["doc_id"]), ["doc_id"])
    counters = review.summary(personal, regulatory, inputs, knowledge)
    review.write_review("extract_20260101_000000", "a.docx", counters, review.report_tables(personal, regulatory, inputs, knowledge), f"file://{tmp_path}")
    told = json.loads((tmp_path / "report.json").read_text())
    assert told["session_id"] == "extract_20260101_000000"
    assert told["summary"] == counters.first().asDict()
    assert "- pii_total: " in (tmp_path / "report.md").read_text()
    assert spark.read.json(f"{tmp_path}/findings/pii_findings").count() == personal.count() > 0
    assert spark.read.json(f"{tmp_path}/findings/knowledge/indicators").count() == 2


def test_model_backed_detector(elements):
    """A detector in Python gets prompts of the chunks that were scheduled, and its answers are parsed as JSON."""

    def answer(batches):
        for batch in batches:
            said = [json.dumps([{"category": "NOTE", "value_example": t[-4:]}]) if "Mail" in t else "no JSON" for t in batch.column("prompt").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(said)], names=["doc_id", "answer"])

    asked = elements.select("doc_id", review.prompt(F.lit("PII"), F.col("content")).alias("prompt"))
    assert asked.first().prompt.startswith("List all personal data")
    found = review.mapped(asked, answer, "doc_id long, answer string")
    parsed = found.select("doc_id", F.explode(review.parsed_findings(F.col("answer"), "struct<category:string,value_example:string>")).alias("f")).select("doc_id", "f.*")
    assert sorted(tuple(r) for r in parsed.collect()) == [(1, "NOTE", "8901"), (2, "NOTE", ".org")]


def test_image_format(spark):
    df = spark.createDataFrame([("a.JPEG", "x"), ("b.tif", "x"), ("c", "image/gif"), ("d.xyz", "image/bmp"), ("e", "x")], "n string, k string")
    assert [r[0] for r in df.select(image_format(F.col("n"), F.col("k"))).collect()] == ["jpg", "tiff", "gif", "bmp", "png"]
