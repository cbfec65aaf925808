"""Turning raw model answers into typed values.

Every step becomes a column of its own, so that a text is stripped, sliced and parsed once however
often later steps refer to it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions.text import col, strip

ITEM = "sample_id string, label string, confidence string, reason string"
ITEM_ARRAY = ("array<struct<sample_id:string, label:string, confidence:string, reason:string>>")
_BAD = "_corrupt_record"
_OPTIONS = {"columnNameOfCorruptRecord": _BAD}


def _staged(df: DataFrame, stages, keep) -> DataFrame:
    """Add the columns of ``stages`` one after the other and keep only those in ``keep``."""
    names = []
    for name, value in stages:
        names.append(name)
        df = df.withColumn(name, value)
    return df.drop(*[n for n in names if n not in keep])


def between(text, opening: str, closing: str) -> Column:
    """Slice from the first opening to the last closing character; null without one."""
    text = col(text)
    start = F.instr(text, opening)
    end = F.length(text) - F.instr(F.reverse(text), closing) + 1
    found = (start > 0) & (F.instr(text, closing) > 0) & (end > start)
    return F.when(found, F.substr(text, start, end - start + 1))


def _fence_stages(raw):
    """``_text``: the answer without white space, code fence and the fence's ``json`` mark."""
    inner = F.col("_inner")
    return [
        ("_raw", strip(raw)),
        ("_inner", F.when(F.col("_raw").startswith("```"),
                          strip(F.regexp_replace("_raw", "^`+|`+$", "")))),
        ("_text", F.when(inner.isNull(), F.col("_raw")).when(
            inner.startswith("json"), strip(F.substr(inner, F.lit(5)))).otherwise(inner)),
    ]


def _parsed(text, schema: str) -> Column:
    return F.from_json(col(text), f"{schema}, {_BAD} string", _OPTIONS)


def _good(name) -> Column:
    """The parsed struct, null when the text was not valid for the schema."""
    return F.when(F.col(name)[_BAD].isNull(), F.col(name))


def with_result_items(df: DataFrame, raw: str, name="items", recover=False) -> DataFrame:
    """Items of a screening answer: whole object, else the array slice, else the object slice.

    Null when nothing parses. A bare top-level array is no result object and gives null too. With
    ``recover`` a column ``recovered`` holds the items of a broken answer: every object that
    starts with ``sample_id``, read on its own, the first one of each id.
    """
    text = F.col("_text")
    schema = f"results {ITEM_ARRAY}"
    empty = F.array().cast(ITEM_ARRAY)
    is_object = text.startswith("{") & text.endswith("}")
    is_array = text.startswith("[") & text.endswith("]")
    whole, inner = _good("_whole"), _good("_part")
    stages = _fence_stages(raw) + [
        ("_whole", F.when(is_object, _parsed("_text", schema))),
        ("_open", F.col("_whole").isNull() | F.col("_whole")[_BAD].isNotNull()),
        ("_list", F.when(F.col("_open"), F.from_json(between("_text", "[", "]"), ITEM_ARRAY))),
        ("_part", F.when(F.col("_open") & F.col("_list").isNull(),
                         _parsed(between("_text", "{", "}"), schema))),
        (name, F.when(~F.col("_open"), F.coalesce(whole["results"], empty))
         .when(is_array & F.col("_list").isNotNull(), F.lit(None))
         .when(F.col("_list").isNotNull(), F.col("_list"))
         .when(F.col("_part").isNotNull() & inner.isNotNull(),
               F.coalesce(inner["results"], empty))),
    ]
    if recover:
        pieces = F.filter(F.split("_text", r'(?=\{\s*"sample_id"\s*:)'),
                          lambda p: p.rlike(r'^\{\s*"sample_id"\s*:'))
        stages += [
            ("_read", F.when(F.col(name).isNull(), F.transform(pieces, lambda p: F.from_json(
                p, f"{ITEM}, {_BAD} string", _OPTIONS)))),
            ("_named", F.filter("_read", lambda s: s[_BAD].isNull()
                                & (strip(s["sample_id"]) != ""))),
            ("_ids", F.transform("_named", lambda s: strip(s["sample_id"]))),
            ("recovered", F.transform(
                F.filter("_named", lambda s, i: F.array_position(
                    "_ids", strip(s["sample_id"])) == i + 1),
                lambda s: F.struct(s["sample_id"].alias("sample_id"), s["label"].alias("label"),
                                   s["confidence"].alias("confidence"),
                                   s["reason"].alias("reason")))),
        ]
    return _staged(df, stages, [name, "recovered"])


def with_prompt_list(df: DataFrame, raw: str, expected, name="prompts") -> DataFrame:
    """Prompts of a generation answer: a JSON array, else its lines without list markers."""
    def values(c):
        return F.filter(F.transform(F.from_json(c, "array<string>"), strip), lambda v: v != "")

    def unmarked(line):
        bare = strip(F.regexp_replace(line, "^-+", ""))
        return F.when(bare.rlike(r"^\d\d.*?\. "),
                      strip(F.regexp_replace(bare, r"^.*?\. ", ""))).otherwise(bare)

    text = F.col("_answer")
    is_array = text.startswith("[") & text.endswith("]")
    breaks = r"\r\n|[\n\r\x0b\f\x1c-\x1e\x85\x{2028}\x{2029}]"
    lines = F.filter(F.transform(F.split("_answer", breaks), strip),
                     lambda v: (v != "") & ~v.startswith("```"))
    stages = [
        ("_answer", strip(raw)),
        ("_whole", F.when(is_array, values(text))),
        ("_slice", F.when(F.coalesce(F.size("_whole"), F.lit(0)) <= 0,
                          values(between("_answer", "[", "]")))),
        (name, F.when(F.size("_whole") > 0, F.col("_whole"))
         .when(F.size("_slice") > 0, F.col("_slice")).otherwise(F.transform(lines, unmarked))),
        (name, F.slice(name, F.lit(1), F.lit(expected) if isinstance(expected, int)
                       else col(expected))),
    ]
    return _staged(df, stages, [name])


SCORES = ["content_preservation", "style_consistency", "degradation_intensity",
          "dimension_accuracy"]
_JUDGE = ("valid boolean, style_type string, failure string, recommended_style string, "
          "notes string, scores struct<" + ", ".join(f"{s}:double" for s in SCORES) + ">")


def _count(text, piece: str) -> Column:
    c = col(text)
    return (F.length(c) - F.length(F.replace(c, F.lit(piece), F.lit("")))) / len(piece)


def _repair_stages():
    """``_fixed``: outer text of a judge answer with trailing commas and brackets mended."""
    start = F.instr("_text", "{")
    cut = F.regexp_replace("_quoted", r',\s*"[^"]*"?\s*:?\s*"?[^"]*$', "")
    return [
        ("_outer", F.coalesce(between("_text", "{", "}"), F.when(
            start > 0, F.substr(F.col("_text"), start, F.length("_text"))))),
        ("_trim", F.regexp_replace(F.regexp_replace("_outer", r",\s*\}", "}"), r",\s*$", "")),
        ("_braces", (_count("_trim", "{") - _count("_trim", "}")).cast("int")),
        ("_brackets", (_count("_trim", "[") - _count("_trim", "]")).cast("int")),
        ("_odd", F.pmod(_count("_trim", '"') - _count("_trim", '\\"'), F.lit(2)) == 1),
        ("_quoted", F.when(F.col("_odd"), F.concat("_trim", F.lit('"'))).otherwise(
            F.col("_trim"))),
        ("_closed", F.when(F.col("_braces") > 0, F.concat(cut, F.repeat(
            F.lit("}"), F.col("_braces")))).otherwise(F.col("_trim"))),
        ("_closed", F.when(F.col("_brackets") > 0, F.concat("_closed", F.repeat(
            F.lit("]"), F.col("_brackets")))).otherwise(F.col("_closed"))),
        ("_fixed", F.regexp_replace(F.regexp_replace("_closed", r",\s*\}", "}"), r",\s*\]",
                                    "]")),
    ]


def _by_field(name) -> Column:
    """Judge fields found one by one in a text that cannot be parsed."""
    text = F.col(name)

    def find(pattern):
        return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))

    def quoted(field):
        pattern = f'"{field}"\\s*:\\s*"([^"]*)"'
        return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))

    no_failure = text.rlike(r'"failure"\s*:\s*null')
    scores = [F.coalesce(find(f'"{s}"\\s*:\\s*([\\d.]+)').try_cast("double"), F.lit(0.0))
              .alias(s) for s in SCORES]
    return F.struct(
        F.coalesce(F.lower(find(r'(?i)"valid"\s*:\s*(true|false)')) == "true",
                   F.lit(False)).alias("valid"),
        F.coalesce(quoted("style_type"), F.lit("realistic")).alias("style_type"),
        F.coalesce(quoted("failure"), F.when(~no_failure, F.lit("unknown"))).alias("failure"),
        quoted("recommended_style").alias("recommended_style"),
        F.coalesce(quoted("notes"), F.lit("")).alias("notes"),
        F.struct(*scores).alias("scores"))


def with_judge_verdict(df: DataFrame, raw: str) -> DataFrame:
    """Typed judge verdict with defaults, repaired or read field by field where needed.

    A missing failure of an invalid pair is inferred from the notes. All verdict columns are null
    when the answer holds no object at all.
    """
    text, inner = F.col("_raw"), F.col("_inner")
    fields = ["valid", "style_type", "failure", "recommended_style", "notes", "scores"]

    def usable(name):
        return F.when(F.col(name)[_BAD].isNull(), F.struct(*[
            F.col(name)[f].alias(f) for f in fields]))

    whole = F.col("_text").startswith("{") & F.col("_text").endswith("}")
    stages = [
        ("_raw", strip(raw)),
        ("_inner", F.when(text.startswith("```"), F.get(F.split(text, "```"), F.lit(1)))),
        ("_text", F.when(inner.isNull(), text).when(
            inner.startswith("json"), strip(F.substr(inner, F.lit(5)))).otherwise(strip(inner))),
        ("_parsed", F.when(whole, _parsed("_text", _JUDGE))),
        ("_verdict", F.when(F.col("_parsed").isNotNull(), usable("_parsed"))),
        *_repair_stages(),
        ("_again", F.when(F.col("_verdict").isNull(), _parsed("_fixed", _JUDGE))),
        ("_verdict", F.coalesce("_verdict", F.when(F.col("_again").isNotNull(),
                                                   usable("_again")))),
        ("_verdict", F.when(F.col("_verdict").isNull() & F.col("_fixed").isNotNull(),
                            _by_field("_fixed")).otherwise(F.col("_verdict"))),
    ]
    df = _staged(df, stages, ["_verdict"])
    v = F.col("_verdict")
    known = v.isNotNull()
    notes = F.coalesce(v["notes"], F.lit(""))
    lowered, valid = F.lower(notes), F.coalesce(v["valid"], F.lit(False))
    inferred = (F.when(lowered.contains("风格") | lowered.contains("style"), F.lit("style_drift"))
                .when(lowered.contains("内容") | lowered.contains("content")
                      | lowered.contains("主体"), F.lit("content_drift"))
                .otherwise(F.lit("insufficient_effect")))
    columns = {
        "valid": valid, "style_type": F.coalesce(v["style_type"], F.lit("realistic")),
        "failure": F.when(~valid & v["failure"].isNull(), inferred).otherwise(v["failure"]),
        "recommended_style": v["recommended_style"], "notes": notes,
        **{s: F.coalesce(v["scores"][s], F.lit(0.0)) for s in SCORES}}
    taken = [c for c in df.columns if c not in columns and c != "_verdict"]
    return df.select(*taken, *[F.when(known, c).alias(n) for n, c in columns.items()])
