"""Review of a corpus: schedule tasks, detect findings, reduce per document and over all, report.

Detectors are expressions over an element's text, so a review is scans and partial aggregates.  A detector
that needs Python is given as ``mapInArrow`` work over the scheduled chunks instead (``mapped``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import evidence

#: What each check loads: all chunks, only chunks with a keyword, workbook tables, pictures; and whether it waits for a flag.
STRATEGY = (
    {"check": "PII", "chunks": "all", "csv": True, "image": False, "flagged": False},
    {"check": "REGULATORY", "chunks": "keyword", "csv": False, "image": False, "flagged": True},
    {"check": "PAGE_INPUT", "chunks": "all", "csv": False, "image": False, "flagged": False},
    {"check": "KNOWLEDGE", "chunks": "all", "csv": True, "image": True, "flagged": False},
)
#: Words that mark a chunk as being about regulatory reports: the specified ones (fixed values), then English ones.
KEYWORDS = ("报送", "监管", "合规", "上报", "披露", "report", "regulat", "complian", "submission", "disclos")
#: Personal data by category: field name and pattern, in Java's and RE2's common syntax.
PERSONAL = {
    "e-mail": ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    "id number": ("id_number", r"\b[0-9]{17}[0-9Xx]\b"),
    "bank card": ("card", r"\b[0-9]{13,16}\b"),
    "mobile": ("phone", r"\+?[0-9]{2,4}[ -][0-9]{3,4}[ -][0-9]{3,4}\b"),
    "password": ("password", r"(?i)\bpass(?:word|wd)\s*[:=]\s*[^\s]+"),
}
#: How a masked value of a category must look.
MASKING = {"e-mail": r"\*{3}@", "id number": r"\*{8}", "bank card": r"\*{4}", "mobile": r"\*{4}", "password": r"\A\*+\z"}
MASKED = r"\*{3}"
#: What every personal datum has in its text: a quick test before the patterns.
PERSONAL_HINT = r"(?i)@|[0-9][0-9]|pass"
#: Attributes that a report item must state, the weightiest first, each with the pattern that states it.
REPORT_ATTRIBUTES = {
    "owner": r"(?i)\bowner\b|dataowner",
    "logic": r"(?i)\blogic\b|\bderived\b|取数逻辑",
    "check_rule": r"(?i)\brule\b|校验规则",
    "name": r"(?i)\bname\b|中文名",
    "definition": r"(?i)\bdefin|口径",
    "scope": r"(?i)\bscope\b|报送范围",
    "check_frequency": r"(?i)\bdaily\b|\bweekly\b|\bmonthly\b|校验频率",
}
#: Rules that an input field should have.
INPUT_RULES = {
    "required": r"(?i)\brequired\b|\bmandatory\b|必填",
    "format": r"(?i)\bformat\b|格式",
    "range": r"(?i)\bbetween\b|\brange\b|枚举|码值|取值范围",
    "precision": r"(?i)\bdecimal|\bprecision\b|精度|小数",
}
#: Kinds of knowledge, by the end or beginning of a word; the endings in Chinese are the specified ones (fixed values).
KNOWLEDGE = {
    "INDICATOR": r"\b[^\W\d_]{3,}(?:rate|ratio|degree)\b|[\x{4e00}-\x{9fa5}]+[率比度]",
    "QUALITY_RULE": r"\b(?:complete|accura|consist|timel|valid)[^\W\d_]*\b|完整性|准确性|一致性|时效性|有效性",
    "TAG": r"\b(?:tag|label|tier|level)[^\W\d_]*\b|标签|画像|分层|等级",
    "DATA_ITEM": r"\b[a-z]+_[a-z_]+\b",
}
CHUNK_TOKENS, CSV_TOKENS, DOCUMENT_TOKENS, GLOBAL_TOKENS = 2000, 3000, 4000, 8000
CALL_SECONDS, REDUCES = 3, 2


def has_keyword(text: Column, keywords: tuple[str, ...] = KEYWORDS) -> Column:
    low = F.lower(text)
    return reduce(lambda x, y: x | y, [low.contains(k) for k in keywords])


def tasks(units: DataFrame, flagged: bool = True) -> DataFrame:
    """Map tasks of ``units (..., task_type, keyword_hit)``, ``task_type`` being chunk, csv or image: one row per unit and check that loads it.

    The strategy is an array in the plan, so units neither shuffle nor join.
    """
    loads = []
    for s in STRATEGY:
        if s["flagged"] and not flagged:
            continue
        chunk = F.lit(True) if s["chunks"] == "all" else F.col("keyword_hit")
        wanted = ((F.col("task_type") == "chunk") & chunk) | ((F.col("task_type") == "csv") & s["csv"]) | ((F.col("task_type") == "image") & s["image"])
        loads.append(F.when(wanted, F.lit(s["check"])))
    return units.withColumn("check_type", F.explode(F.array_compact(F.array(*loads))))


def mapped(chunks: DataFrame, detector: Callable, schema: str) -> DataFrame:
    """Findings of a Python detector: ``detector`` takes and yields Arrow batches.  Filter ``chunks`` first: no filter passes below it."""
    return chunks.mapInArrow(detector, schema)


def personal_findings(elements: DataFrame, keys: list[str]) -> DataFrame:
    """Personal data in ``elements (keys, position, content)``: one row per value found."""

    def values(category: str, field: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all("content", F.lit(pattern), F.lit(0)), lambda v: F.struct(F.lit(category).alias("category"), F.lit(field).alias("field"), v.alias("value_example")))

    kinds = [values(category, field, pattern) for category, (field, pattern) in PERSONAL.items()]
    likely = elements.where(F.col("content").rlike(PERSONAL_HINT))
    found = likely.select(*keys, "position", evidence(F.col("content"), 100).alias("evidence"), F.explode_outer(F.concat(*kinds)).alias("f")).where("f is not null")
    return found.select(*keys, "position", "f.category", "f.field", "f.value_example", F.col("f.value_example").rlike(MASKED).alias("has_masking"), "evidence")


def risk(category: Column, value: Column, has_masking: Column) -> Column:
    """HIGH without masking, MEDIUM if masked otherwise than the category's rule, LOW else."""
    fits = reduce(lambda x, y: x | y, [(category == c) & value.rlike(p) for c, p in MASKING.items()])
    return F.when(~has_masking, "HIGH").when(~fits, "MEDIUM").otherwise("LOW")


#: Characters of a rule table's patterns and verdicts up to which every executor gets a copy of it.
MOST_RULES = 4_000_000


def by_rules(findings: DataFrame, rules: DataFrame, default: str = "LOW", category: str = "category", value: str = "value_example", out: str = "verdict", most: int = MOST_RULES) -> DataFrame:
    """``findings`` with ``out``, the verdict of the first rule that matches; ``default`` where none does.

    ``rules (category, order, pattern, verdict)`` is a table: a rule is for the findings of its category, or for all if
    that is null, and matches values in which its pattern is found.  The rule with the smallest order decides, among
    equal ones the smaller pattern.  Rules come together by category and meet the findings in one join on it, with
    a copy for every executor as long as they are small; beyond, Spark shuffles both sides and splits a large category.
    Findings with a null category only meet the rules for all; a null value matches nothing.
    """
    rule = F.struct("order", "pattern", "verdict")
    given = rules.where("pattern is not null")
    size = given.agg(F.sum(F.length("pattern") + F.coalesce(F.length("verdict"), F.lit(0)))).first()[0] or 0
    copied = F.broadcast if size <= most else lambda df: df
    own = given.where("category is not null").groupBy(F.col("category").alias("__category")).agg(F.collect_list(rule).alias("__own"))
    general = given.where("category is null").agg(F.collect_list(rule).alias("__all"))  # one row
    met = findings.join(copied(own), findings[category] == own["__category"], "left").join(copied(general), how="left", on=F.lit(True))
    ordered = F.array_sort(F.concat(F.coalesce("__own", F.array().cast(own.schema["__own"].dataType)), F.col("__all")))
    first = F.get(F.filter(ordered, lambda r: F.rlike(F.col(value), r["pattern"])), F.lit(0))["verdict"]
    return met.withColumn(out, F.coalesce(first, F.lit(default))).drop("__category", "__own", "__all")


def personal_by_document(findings: DataFrame, keys: list[str]) -> DataFrame:
    """Findings merged within a document, with all their positions."""
    merged = findings.groupBy(*keys, "category", "field", "value_example").agg(F.sort_array(F.collect_set("position")).alias("pos"), F.min("has_masking").alias("has_masking"), F.min("evidence").alias("evidence"))
    return merged.withColumn("risk", risk(F.col("category"), F.col("value_example"), F.col("has_masking")))


def personal_overall(by_document: DataFrame, keys: list[str]) -> DataFrame:
    """Findings merged over all documents: counts and the first document, since one value may stand in any number of them."""
    first = F.min(F.struct(*keys)).alias("first")
    merged = by_document.groupBy("category", "field", "value_example").agg(F.count("*").alias("documents"), F.sum(F.size("pos")).alias("places"), F.min("has_masking").alias("has_masking"), first)
    return merged.select("category", "field", "value_example", "documents", "places", *[F.col(f"first.{k}").alias(f"first_{k}") for k in keys], risk(F.col("category"), F.col("value_example"), F.col("has_masking")).alias("risk"))


def places(findings: DataFrame, finding: list[str], keys: list[str]) -> DataFrame:
    """Where merged findings stand: ``(finding, keys, pos, evidence)``, a row per finding and document.

    The small rows of a merge over all documents keep counts; this table keeps every position and its evidence, side by
    side and in order, and joins with them on ``finding``.  Only what one document holds comes together in a row.
    """
    held = F.sort_array(F.collect_set(F.struct("position", "evidence")))
    return findings.groupBy(*finding, *keys).agg(held.alias("held")).select(*finding, *keys, F.col("held.position").alias("pos"), F.col("held.evidence").alias("evidence"))


RISKS = ("HIGH", "MEDIUM", "LOW")


def risk_order(risk_col: Column) -> Column:
    return F.array_position(F.array(*[F.lit(r) for r in RISKS]), risk_col).cast("int")


def _stated(patterns: dict[str, str], text: Column) -> Column:
    """A bit for each pattern that ``text`` holds."""
    return reduce(lambda x, y: x.bitwiseOR(y), [F.when(text.rlike(p), 1 << k).otherwise(0) for k, p in enumerate(patterns.values())])


def _named(bits: Column, names: list[str]) -> Column:
    return F.array_compact(F.array(*[F.when(bits.bitwiseAND(1 << k) != 0, F.lit(n)) for k, n in enumerate(names)]))


def _rank(name: Column, names: list[str]) -> Column:
    return F.coalesce(F.array_position(F.array(*[F.lit(n) for n in names]), name), F.lit(len(names) + 1)).cast("int")


def regulatory_findings(elements: DataFrame, keys: list[str], patterns: dict[str, str] = REPORT_ATTRIBUTES) -> DataFrame:
    """Elements as report items, named by their first word, with a bit for each attribute that they do not state."""
    every = (1 << len(patterns)) - 1
    item = F.lower(F.regexp_extract("content", r"[^\W\d_]+", 0))
    missing = F.lit(every) - _stated(patterns, F.col("content"))
    return elements.select(*keys, "position", item.alias("item_name"), missing.alias("missing"), evidence(F.col("content"), 200).alias("evidence")).where("item_name <> ''")


def regulatory_overall(findings: DataFrame, keys: list[str], patterns: dict[str, str] = REPORT_ATTRIBUTES) -> DataFrame:
    """Items merged over all places: everything that any of them lacks, the lack that weighs most, and how often they occur.

    ``severity_rank`` orders a report: 1 for the weightiest lack, one more than there are attributes for none.
    """
    merged = findings.groupBy("item_name").agg(F.bit_or("missing").alias("bits"), F.count("*").alias("places"))
    return regulatory_listed(merged, patterns)


def regulatory_listed(merged: DataFrame, patterns: dict[str, str] = REPORT_ATTRIBUTES) -> DataFrame:
    """Items ``(item_name, bits, places)`` as a report lists them."""
    names = list(patterns)
    listed = _named(F.col("bits"), names)
    return merged.select("item_name", F.array_join(listed, ",").alias("missing_fields"), F.coalesce(F.get(listed, F.lit(0)), F.lit("none")).alias("severity"), _rank(F.get(listed, F.lit(0)), names).alias("severity_rank"), "places")


def input_findings(elements: DataFrame, keys: list[str], location: Column, patterns: dict[str, str] = INPUT_RULES) -> DataFrame:
    """Elements with a colon as input fields: the name before it, the place where they are, and the rules that are missing."""
    every = (1 << len(patterns)) - 1
    name = F.lower(F.trim(F.substring_index("content", ":", 1)))
    return elements.where(F.col("content").contains(":")).select(*keys, "position", evidence(name, 40).alias("field_name"), location.alias("field_location"), (F.lit(every) - _stated(patterns, F.col("content"))).alias("missing"), evidence(F.col("content"), 200).alias("evidence"))


def input_overall(findings: DataFrame, patterns: dict[str, str] = INPUT_RULES) -> DataFrame:
    """Fields merged over all places, with the number of rules that are missing somewhere."""
    merged = findings.groupBy("field_name", "field_location").agg(F.bit_or("missing").alias("bits"), F.count("*").alias("places"))
    return merged.select("field_name", "field_location", F.array_join(_named(F.col("bits"), list(patterns)), ",").alias("missing_rules"), F.bit_count("bits").cast("int").alias("n_missing"), "places")


def knowledge_findings(elements: DataFrame, keys: list[str], patterns: dict[str, str] = KNOWLEDGE) -> DataFrame:
    """Words of each kind in ``elements (keys, position, content)``: one row per word found."""

    def names(category: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(F.lower("content"), F.lit(pattern), F.lit(0)), lambda v: F.struct(F.lit(category).alias("category"), v.alias("name")))

    kinds = [names(category, pattern) for category, pattern in patterns.items()]
    found = elements.select(*keys, "position", evidence(F.col("content"), 200).alias("evidence"), F.explode_outer(F.concat(*kinds)).alias("f")).where("f is not null")
    return found.select(*keys, "position", "f.category", "f.name", "evidence")


def knowledge_overall(findings: DataFrame, keys: list[str]) -> DataFrame:
    """Entries merged over all places: how many, and the first of them with its evidence."""
    first = F.min(F.struct(*keys, "position", "evidence")).alias("first")
    merged = findings.groupBy("category", "name").agg(F.count("*").alias("places"), first)
    return merged.select("category", "name", "places", *[F.col(f"first.{k}").alias(f"first_{k}") for k in keys], F.col("first.position").alias("first_position"), F.col("first.evidence").alias("evidence"))


#: The four lists of a report's knowledge, by the category of their entries.
KNOWLEDGE_LISTS = {"indicators": "INDICATOR", "tags": "TAG", "data_items": "DATA_ITEM", "quality_rules": "QUALITY_RULE"}


def knowledge_lists(overall: DataFrame) -> dict[str, DataFrame]:
    """The entries of ``knowledge_overall`` as the four lists of a report."""
    return {name: overall.where(F.col("category") == kind).drop("category") for name, kind in KNOWLEDGE_LISTS.items()}


def summary(personal: DataFrame, regulatory: DataFrame, inputs: DataFrame, knowledge: DataFrame) -> DataFrame:
    """The six counters of a report, in one row."""
    parts = [
        personal.agg(F.count("*").alias("pii_total"), F.count_if(F.col("risk") == "HIGH").alias("pii_high_risk")),
        regulatory.agg(F.count_if(F.col("missing_fields") != "").alias("regulatory_missing")),
        inputs.agg(F.count_if(F.col("n_missing") > 0).alias("page_input_missing_rules")),
        knowledge.agg(F.count_if(F.col("category") == "INDICATOR").alias("indicators_extracted"), F.count_if(F.col("category") == "TAG").alias("tags_extracted")),
    ]
    keyed = [p.withColumn("one", F.lit(1)) for p in parts]  # single rows, brought together
    return reduce(lambda x, y: x.join(y, "one"), keyed).drop("one")


def token_budget(units: DataFrame, keys: list[str]) -> DataFrame:
    """Tokens that the model reads for each document: its map tasks, and with both reduces."""
    load = F.sum(F.when(F.col("task_type") == "csv", CSV_TOKENS).when(F.col("task_type") == "chunk", CHUNK_TOKENS).otherwise(0))
    return units.groupBy(*keys).agg(load.alias("map_tokens")).withColumn("total_tokens", F.col("map_tokens") + DOCUMENT_TOKENS + GLOBAL_TOKENS)


def wall_time(units: DataFrame, keys: list[str]) -> DataFrame:
    """Seconds of a review with documents side by side, one after the other, and with all tasks side by side."""
    per = units.groupBy(*keys).agg(F.count("*").alias("n"))
    return per.agg((F.max("n") * CALL_SECONDS + REDUCES * CALL_SECONDS).alias("parallel_s"), (F.sum("n") * CALL_SECONDS + REDUCES * CALL_SECONDS).alias("serial_s"), F.lit(CALL_SECONDS * (1 + REDUCES)).cast("long").alias("full_parallel_s"))


#: Texts that a model-backed detector would be given, by check.
PROMPTS = {
    "PII": "List all personal data in the text below as a JSON array with category, field, value_example, evidence of at most 100 characters, pos and has_masking.",
    "REGULATORY": "List the report items in the text below as a JSON array with item_name, missing_fields, has_quality_rule, evidence of at most 200 characters and pos.",
    "PAGE_INPUT": "List the input fields in the text below as a JSON array with field_name, field_location, the rules that each has or lacks, evidence and pos.",
    "KNOWLEDGE": "List the data items, quality rules, indicators and tags in the text below as a JSON array with category, name, definition, attributes, evidence and pos.",
}


def prompt(check: Column, text: Column) -> Column:
    texts = F.create_map(*[F.lit(x) for pair in PROMPTS.items() for x in pair])
    return F.concat(F.try_element_at(texts, check), F.lit("\n\n"), text)


def parsed_findings(answer: Column, schema: str) -> Column:
    """A model's JSON answer as an array of structs; null if it is not JSON of that form."""
    return F.from_json(answer, f"array<{schema}>")


def _object(depth: int) -> str:
    """A pattern of a whole JSON object that holds others down to a depth."""
    inner = "" if depth == 0 else f"|{_object(depth - 1)}"
    return r'\{(?:[^{}"]++|"(?:[^"\\]++|\\.)*+"' + inner + r")*+\}"


#: Objects in an answer that as a whole is no JSON.
OBJECT = "(?s)" + _object(4)


def salvaged(answers: DataFrame, fields: dict[str, str], required: list[str], answer: str = "answer") -> tuple[DataFrame, DataFrame]:
    """Findings of imperfect answers, and what had to be left: ``(..., k, fields)`` and ``(..., k, text, reason)``.

    An answer that is a JSON array, or one object, is taken element by element.  Of any other, such as one that was cut off or
    has words around it, the whole objects are taken, and the rest is a reject by itself.  An element fits if it is an
    object, has the ``required`` fields, and each field that it has can be read as the type that ``fields`` names; elements
    that do not fit are rejects one by one, so one of them costs no other.  ``k`` is the element's place from 0.  Null
    answers give neither; every other one leaves at least one row unless it is an empty array.
    """
    whole = F.try_parse_json(answer)
    kind = F.schema_of_variant(whole)
    listed = F.when(kind.startswith("ARRAY"), F.transform(F.variant_get(whole, "$", "array<variant>"), lambda v: F.to_json(v))).when(kind.startswith("OBJECT"), F.array(F.to_json(whole)))
    broken = F.regexp_extract_all(answer, F.lit(OBJECT), F.lit(0))
    rest = F.regexp_replace(F.regexp_replace(answer, OBJECT, ""), r"\A[\s\[,]+|[\s\],]+\z", "")
    keys = [c for c in answers.columns if c != answer]
    parts = answers.where(F.col(answer).isNotNull()).select(*keys, listed.isNull().alias("__broken"), F.coalesce(listed, broken).alias("__texts"), rest.alias("__rest"))
    items = parts.select(*keys, F.posexplode("__texts").alias("k", "text")).withColumn("v", F.try_parse_json("text"))
    read = {name: F.try_variant_get("v", f"$.{name}", kind) for name, kind in fields.items()}
    held = lambda name: F.try_variant_get("v", f"$.{name}", "variant")
    absent = lambda name: held(name).isNull() | F.is_variant_null(held(name))
    wrong = F.array_compact(F.array(*[F.when(c.isNull() & ~absent(n), F.lit(n)) for n, c in read.items()]))
    lacking = F.array_compact(F.array(*[F.when(absent(n), F.lit(n)) for n in required]))
    reason = (
        F.when(~F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False)), F.lit("not an object"))
        .when(F.size(lacking) > 0, F.concat(F.lit("lacks "), F.array_join(lacking, ", ")))
        .when(F.size(wrong) > 0, F.concat(F.lit("another type of "), F.array_join(wrong, ", ")))
    )
    judged = items.select(*keys, "k", "text", *[c.alias(n) for n, c in read.items()], reason.alias("reason"))
    left = parts.where("__broken and __rest <> ''").select(*keys, F.size("__texts").alias("k"), F.col("__rest").alias("text"), F.lit("no whole element").alias("reason"))
    return judged.where("reason is null").drop("text", "reason"), judged.where("reason is not null").select(*keys, "k", "text", "reason").unionByName(left)


def report_tables(personal: DataFrame, regulatory: DataFrame, inputs: DataFrame, knowledge: DataFrame) -> dict[str, DataFrame]:
    """The tables of a report in their order, by the folder that each belongs in."""
    lists = {f"findings/knowledge/{name}": rows.orderBy("name") for name, rows in knowledge_lists(knowledge).items()}
    return {
        "findings/pii_findings": personal.orderBy("category", risk_order(F.col("risk")), "value_example"),
        "findings/regulatory_findings": regulatory.orderBy("severity_rank", "item_name"),
        "findings/page_input_findings": inputs.orderBy(F.desc("n_missing"), "field_name", "field_location"),
        **lists,
    }


def write_review(session: str, source: str, counters: DataFrame, tables: dict[str, DataFrame], folder: str) -> None:
    """Writes a report below ``folder``: ``report.json`` and ``report.md`` with the counters of ``summary``, and each table as a folder of JSON lines."""
    from quire.sources.sinks import write_files

    names = counters.columns
    head = report(F.lit(session), F.lit(source), F.current_timestamp(), {n: F.col(n) for n in names})
    lines = F.concat(F.lit(f"# {session}\n\nSource: {source}\n\n"), *[F.concat(F.lit(f"- {n}: "), F.col(n).cast("string"), F.lit("\n")) for n in names])
    files = F.array(F.struct(F.lit("report.json").alias("path"), head.alias("content")), F.struct(F.lit("report.md").alias("path"), lines.alias("content")))
    write_files(counters.select(F.inline(files)), folder).collect()  # two rows
    for name, rows in tables.items():
        rows.write.mode("overwrite").json(f"{folder}/{name}")


def report(session: Column, source: Column, generated_at: Column, counters: dict[str, Column]) -> Column:
    """A report's head and summary as JSON; the findings are tables of their own."""
    return F.to_json(F.struct(session.alias("session_id"), source.alias("source_file"), F.date_format(generated_at, "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"), F.struct(*[c.alias(k) for k, c in counters.items()]).alias("summary")))
