"""Batch validation of JSON scoring requests and response assembly.

Each request is checked inside its own row, so validation needs no shuffle; only
requests within the instance limit are exploded, which bounds every group later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark import settings as S
from waymark.functions.columns import computed_once
from waymark.functions.parsing import DECIMAL

# Outcome codes and texts of the scoring interface.
OK, BAD_JSON, INVALID, FAILED = 200, 400, 422, 500
BAD_JSON_TEXT = "Invalid JSON body"
EMPTY_TEXT = "Body must contain one or more instances"
NON_FINITE = r"^[+-]?(inf|infinity|nan)$"


def parse_requests(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``readable``, ``instances`` (array of VARIANT) and ``n_instances``.

    Accepts ``{"instances": [...]}``, ``{"inputs": [...]}``, a list or one object.
    ``instances`` is NULL when the body is unreadable or holds no list;
    ``readable`` tells the two apart.
    """
    doc = F.col("_doc")
    parsed = computed_once(df, {"_doc": F.try_parse_json(F.col(body))})
    parsed = computed_once(parsed, {
        "_object": F.schema_of_variant(doc).startswith("OBJECT"),
        "_wrapped": F.coalesce(F.try_variant_get(doc, "$.instances", "variant"), F.try_variant_get(doc, "$.inputs", "variant")),
    })
    chosen = F.when(F.col("_object") & F.col("_wrapped").isNull(), F.array(doc)).otherwise(
        F.try_variant_get(F.when(F.col("_object"), F.col("_wrapped")).otherwise(doc), "$", "array<variant>"))
    return (
        computed_once(parsed, {"readable": doc.isNotNull(), "instances": chosen})
        .withColumn("n_instances", F.coalesce(F.size("instances"), F.lit(0)))
        .drop("_doc", "_object", "_wrapped")
    )


def explode_requests(df: DataFrame, body: str = "body", max_instances: int = S.MAX_INSTANCES) -> DataFrame:
    """One row per instance of every readable request within the limit."""
    parsed = parse_requests(df, body).where((F.col("n_instances") > 0) & (F.col("n_instances") <= max_instances))
    others = [c for c in df.columns if c != body]
    return parsed.select(*others, "n_instances", F.posexplode("instances").alias("row_index", "instance"))


def _first(errors: Column) -> Column:
    return F.get(F.array_compact(errors), F.lit(0))


def _cell(name: Column, value: Column) -> Column:
    """One feature value as (name, VARIANT kind, text, number)."""
    return F.struct(
        name.alias("name"), F.coalesce(F.schema_of_variant(value), F.lit("VOID")).alias("kind"),
        F.trim(F.try_variant_get(value, "$", "string")).alias("text"),
        F.try_variant_get(value, "$", "double").alias("number"))


def _plain_pattern(features: Sequence[str]) -> str:
    """Matches the VARIANT schema of an object with exactly these fields, all finite numbers.

    ``DOUBLE`` is left to the full check: a literal such as 1e400 reads as infinity.
    """
    number = r"(BIGINT|DECIMAL\(\d+,\d+\))"
    return "^OBJECT<" + ", ".join(f"{f}: {number}" for f in sorted(features)) + ">$"


def _cell_error(cell: Column, row: Column) -> Column:
    kind, text = cell["kind"], cell["text"]
    is_text = kind == "STRING"
    is_number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    as_double = F.when(is_number, cell["number"]).when(text.rlike(DECIMAL), text.try_cast("double"))

    def message(problem: str) -> Column:
        return F.concat(F.lit("Feature '"), cell["name"], F.lit(f"' {problem} at row "), row.cast("string"))

    return (
        F.when(kind == "VOID", message("is null"))
        .when(is_text & F.lower(text).rlike(NON_FINITE), message("must be finite"))
        .when(~(is_number | (is_text & text.rlike(DECIMAL))), message("must be numeric"))
        .when(~(F.abs(as_double) < F.lit(float("inf"))), message("must be finite"))
    )


def _row_error(checked: Column, row: Column) -> Column:
    at = row.cast("string")
    return F.coalesce(
        F.when(F.size(checked["missing"]) > 0, F.concat(
            F.lit("Missing required features at row "), at, F.lit(": "), F.array_join(checked["missing"], ", "))),
        F.when(F.size(checked["extra"]) > 0, F.concat(
            F.lit("Unexpected features at row "), at, F.lit(": "), F.array_join(checked["extra"], ", "))),
        _first(F.transform(checked["cells"], lambda c: _cell_error(c, row))),
    )


def validate_requests(df: DataFrame, features: Sequence[str] = S.FEATURES, body: str = "body",
                      max_instances: int = S.MAX_INSTANCES, allow_extra: bool = False) -> DataFrame:
    """Add ``status_code`` and ``error`` (first failure) to each request."""
    parsed = parse_requests(df, body)
    wanted = F.array(*[F.lit(f) for f in features])
    no_names = F.array().cast("array<string>")
    n = F.col("n_instances")
    kinds = computed_once(parsed, {"_kinds": F.transform("instances", F.schema_of_variant)})
    not_object = F.transform("_kinds", lambda k, i: F.when(
        ~k.startswith("OBJECT"), F.concat(F.lit("Instance at index "), i.cast("string"), F.lit(" must be an object"))))
    shape_error = (
        F.when(~F.col("readable"), F.lit(BAD_JSON_TEXT))
        .when(n < 1, F.lit(EMPTY_TEXT))
        .otherwise(F.coalesce(_first(not_object), F.when(n > max_instances, F.concat(
            F.lit("Too many instances: "), n.cast("string"), F.lit(f" > {max_instances}")))))
    )
    shaped = computed_once(kinds, {"_shape_error": shape_error})
    # Only requests that passed the shape checks have their values looked at, and of
    # those only instances that are not already plain numbers under the right names.
    suspect = F.transform("instances", lambda x, i: F.when(
        ~F.get(F.col("_kinds"), i).rlike(_plain_pattern(features)), F.try_variant_get(x, "$", "map<string,variant>")))
    shaped = computed_once(shaped, {"_fields": F.when(F.col("_shape_error").isNull(), suspect)})
    checked = computed_once(shaped, {"_checked": F.transform("_fields", lambda m: F.when(m.isNotNull(), F.struct(
        F.array_except(wanted, F.map_keys(m)).alias("missing"),
        (no_names if allow_extra else F.array_sort(F.array_except(F.map_keys(m), wanted))).alias("extra"),
        F.transform(F.transform(wanted, lambda f: F.struct(f.alias("name"), F.try_element_at(m, f).alias("value"))),
                    lambda c: _cell(c["name"], c["value"])).alias("cells"))))})
    checked = computed_once(checked, {"error": F.coalesce("_shape_error", _first(F.transform("_checked", _row_error)))})
    status = F.when(F.col("error").isNull(), OK).when(~F.col("readable"), BAD_JSON).otherwise(INVALID)
    return checked.withColumn("status_code", status).drop("readable", "_kinds", "_shape_error", "_fields", "_checked")


def _features(features: Sequence[str], default: float | None = None) -> list[Column]:
    read = {f: F.trim(F.try_variant_get("_instance", f"$.{f}", "string")).try_cast("double").cast("float") for f in features}
    if default is not None:
        read = {f: F.coalesce(c, F.lit(default).cast("float")) for f, c in read.items()}
    return [c.alias(f) for f, c in read.items()]


def feature_rows(validated: DataFrame, key: str, features: Sequence[str] = S.FEATURES) -> DataFrame:
    """Float features in contract order, one row per instance of every good request."""
    good = validated.where(F.col("status_code") == OK)
    return (good.select(key, "n_instances", F.posexplode("instances").alias("row_index", "_instance"))
            .select(key, "n_instances", "row_index", *_features(features)))


def scoring_rows(validated: DataFrame, key: str, features: Sequence[str] = S.FEATURES) -> DataFrame:
    """:func:`feature_rows` plus one placeholder row (``row_index`` NULL) per rejected request.

    The verdict travels with the rows, so the bodies are parsed once and responses
    need no join back.
    """
    instances = F.when(F.col("status_code") == OK, F.col("instances"))
    rows = validated.select(key, "n_instances", "status_code", "error",
                            F.posexplode_outer(instances).alias("row_index", "_instance"))
    return rows.select(key, "n_instances", "status_code", "error", "row_index", *_features(features, 0.0))


def quarantine(validated: DataFrame, key: str, body: str = "body") -> DataFrame:
    return validated.where(F.col("status_code") != OK).select(key, "status_code", "error", body)


def response_rows(scored: DataFrame, key: str, model_version: str, prediction: str = "prediction_seconds") -> DataFrame:
    """One response per request from scored :func:`scoring_rows`; predictions keep the instance order.

    A request holds at most the instance limit, so its list is bounded.
    """
    point = F.when(F.col("row_index").isNotNull(), F.struct("row_index", F.col(prediction).alias("p")))
    grouped = scored.groupBy(key).agg(
        F.first("n_instances").alias("n_instances"), F.first("status_code").alias("_status"),
        F.first("error", ignorenulls=True).alias("_error"), F.sort_array(F.collect_list(point)).alias("_p"))
    failed = (F.col("_status") == OK) & (F.size("_p") != F.col("n_instances"))
    code = F.when(failed, FAILED).otherwise(F.col("_status"))
    good = F.to_json(F.struct(F.lit(model_version).alias("model_version"), F.col("n_instances"),
                              F.transform("_p", lambda x: x["p"]).alias("predictions")))
    detail = F.to_json(F.struct(F.coalesce(F.col("_error"), F.lit("Inference failed")).alias("detail")))
    return grouped.select(key, code.alias("status_code"), F.when(code == OK, good).otherwise(detail).alias("response"))


def slow_requests(log: DataFrame, threshold_ms: float = S.SLOW_REQUEST_MS) -> DataFrame:
    return log.where(F.col("latency_ms") >= threshold_ms)


def failed_requests(log: DataFrame) -> DataFrame:
    return log.where(F.col("status_code") >= 400)
