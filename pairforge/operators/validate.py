"""Structural validation of chat records and their length statistics.

Records are VARIANT values (parsed JSON lines, or typed records through
``to_variant_object``). The problem list of a record is built from built-in
variant and higher-order functions, row by row: no grouping, no Python.

Problem texts (the first three are the reference's):

* ``missing 'messages' key`` - alone, nothing else is checked;
* ``unexpected role order: [...]`` - roles must be system, user, assistant
  exactly; a missing role shows as ``None``;
* ``empty content for role '<role>'`` - per message, content missing, JSON null
  or blank after strip;
* ``'messages' is not a list`` and ``non-string content for role '<role>'`` -
  cases where the reference fails instead of reporting.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.functions.text import py_str_repr, py_strip, word_count
from pairforge.operators.chat import render_prompt
from pairforge.operators.select import kth_key, lex_cmp, _dtypes
from pairforge.sources.jsonl import TOO_LONG

# Fixed value: the role order every record must have.
EXPECTED_ROLES = ["system", "user", "assistant"]
STAT_ROLES = ["user", "assistant"]
# The texts of the problems.
MISSING_KEY = "missing 'messages' key"
NOT_A_LIST = "'messages' is not a list"
WRONG_ORDER = "unexpected role order: ["
EMPTY_CONTENT = "empty content for role '"
OTHER_CONTENT = "non-string content for role '"


def _field(m: Column, name: str) -> Column:
    return F.try_variant_get(m, f"$.{name}", "variant")


def _is_string(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == F.lit("STRING"), F.lit(False))


def _as_string(v: Column) -> Column:
    return F.when(_is_string(v), F.variant_get(v, "$", "string"))


def _is_none(v: Column) -> Column:
    return v.isNull() | F.coalesce(F.is_variant_null(v), F.lit(False))


def _bool_text(v: Column) -> Column:
    return F.when(F.variant_get(v, "$", "boolean"), F.lit("True")).otherwise(F.lit("False"))


def _role_text(r: Column) -> Column:
    """``str(msg.get('role'))``."""
    return (
        F.when(_is_none(r), F.lit("None"))
        .when(_is_string(r), _as_string(r))
        .when(F.schema_of_variant(r) == F.lit("BOOLEAN"), _bool_text(r))
        .otherwise(F.to_json(r))
    )


def _role_repr(r: Column) -> Column:
    """``repr(msg.get('role'))`` as printed inside a list."""
    return F.when(_is_string(r), py_str_repr(_as_string(r))).otherwise(_role_text(r))


def messages_of(record: Column) -> Column:
    return F.try_variant_get(record, "$.messages", "array<variant>")


def record_problems(record: Column) -> Column:
    """``array<string>`` of problems of one record (empty when valid)."""
    absent = _field(record, "messages").isNull()
    msgs = messages_of(record)
    roles_ok = F.size(msgs) == F.lit(len(EXPECTED_ROLES))
    for i, role in enumerate(EXPECTED_ROLES):
        roles_ok = roles_ok & F.coalesce(_as_string(_field(msgs[i], "role")) == F.lit(role), F.lit(False))
    order_problem = F.when(
        ~roles_ok,
        F.concat(
            F.lit(WRONG_ORDER),
            F.array_join(F.transform(msgs, lambda m: _role_repr(_field(m, "role"))), ", "),
            F.lit("]"),
        ),
    )

    def content_problem(m: Column) -> Column:
        c = _field(m, "content")
        role = _role_text(_field(m, "role"))
        return (
            F.when(_is_none(c), F.concat(F.lit(EMPTY_CONTENT), role, F.lit("'")))
            .when(~_is_string(c), F.concat(F.lit(OTHER_CONTENT), role, F.lit("'")))
            .when(py_strip(_as_string(c)) == F.lit(""), F.concat(F.lit(EMPTY_CONTENT), role, F.lit("'")))
        )

    checked = F.array_compact(F.concat(F.array(order_problem), F.transform(msgs, content_problem)))
    return (
        F.when(absent, F.array(F.lit(MISSING_KEY)))
        .when(msgs.isNull(), F.array(F.lit(NOT_A_LIST)))
        .otherwise(checked)
    )


def typed_problems(messages: Column) -> Column:
    """``record_problems`` for records already typed as
    ``array<struct<role string, content string>>`` (no VARIANT round trip)."""
    roles_ok = F.size(messages) == F.lit(len(EXPECTED_ROLES))
    for i, role in enumerate(EXPECTED_ROLES):
        roles_ok = roles_ok & F.coalesce(messages[i]["role"] == F.lit(role), F.lit(False))

    def role_repr(m: Column) -> Column:
        return F.when(m["role"].isNull(), F.lit("None")).otherwise(py_str_repr(m["role"]))

    def role_text(m: Column) -> Column:
        return F.coalesce(m["role"], F.lit("None"))

    order_problem = F.when(
        ~roles_ok,
        F.concat(F.lit(WRONG_ORDER), F.array_join(F.transform(messages, role_repr), ", "), F.lit("]")),
    )
    content = F.transform(
        messages,
        lambda m: F.when(
            F.coalesce(py_strip(m["content"]), F.lit("")) == F.lit(""),
            F.concat(F.lit(EMPTY_CONTENT), role_text(m), F.lit("'")),
        ),
    )
    checked = F.array_compact(F.concat(F.array(order_problem), content))
    return F.when(messages.isNull(), F.array(F.lit(NOT_A_LIST))).otherwise(checked)


def _is_typed(df: DataFrame, col: str) -> bool:
    from pyspark.sql.types import VariantType

    return not isinstance(df.schema[col].dataType, VariantType)


def typed_record(messages: Column) -> Column:
    """VARIANT record ``{"messages": [...]}`` from a typed messages column."""
    return F.to_variant_object(F.struct(messages.alias("messages")))


def validate_records(df: DataFrame, record_col: str = "record") -> DataFrame:
    """Adds ``problems``. ``record_col`` is a VARIANT record or a typed
    ``messages`` array."""
    if _is_typed(df, record_col):
        return df.withColumn("problems", typed_problems(F.col(record_col)))
    problems = record_problems(F.col(record_col))
    if "too_long" in df.columns:  # from ``parse_lines``: such a line has no record to check
        problems = F.when(F.col("too_long"), F.array(F.lit(TOO_LONG))).otherwise(problems)
    return df.withColumn("problems", problems)


def invalid_records(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("problems") > 0)


def problem_text(problems: Column) -> Column:
    return F.array_join(problems, ", ")


def problem_head(validated: DataFrame, order_cols: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` invalid records in record order with their 0-based index
    among *all* records, and how many invalid records follow (``more``).

    Only ``(order key, problems)`` is persisted, so the validation runs once.
    The n-th invalid key comes from a bounded selection, and the indexes of the
    at most ``n`` head records are ``n`` conditional counts in one aggregation
    pass; there is no global row numbering. The result has at most ``n`` rows and
    is returned as a literal frame, so the cache is released before returning.
    """
    from pairforge.session import literal_frame

    cols = list(order_cols)
    dtypes = _dtypes(validated, cols)
    v = validated.select(*cols, "problems").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        bad = v.filter(F.size("problems") > 0)
        t = kth_key(bad, cols, n) if n > 0 else None
        head = bad if t is None else bad.filter(lex_cmp(cols, t, dtypes, "<="))
        head_rows = [tuple(r) for r in head.select(*cols, problem_text(F.col("problems"))).collect()] if n > 0 else []
        aggs = [F.count_if(F.size("problems") > 0).alias("bad")]
        aggs += [F.count_if(lex_cmp(cols, r[: len(cols)], dtypes, "<")).alias(f"i{j}") for j, r in enumerate(head_rows)]
        stats = v.agg(*aggs).first()
    finally:
        v.unpersist()
    more = max(int(stats["bad"]) - len(head_rows), 0)
    rows = [(*r[: len(cols)], int(stats[f"i{j}"]), r[len(cols)], more) for j, r in enumerate(head_rows)]
    ddl = ", ".join([f"`{c}` {dt.simpleString()}" for c, dt in zip(cols, dtypes)] + ["idx bigint", "problems string", "more bigint"])
    return literal_frame(validated.sparkSession, rows, ddl)


def message_words(records: DataFrame, record_col: str = "record", group_cols: Sequence[str] = ()) -> DataFrame:
    """One row per message of a stats role: ``*group_cols, role, wc``.

    Missing or JSON-null content counts 0 words (``msg.get('content', '')``);
    non-string content is skipped.
    """
    if _is_typed(records, record_col):
        m = records.select(*group_cols, F.explode(F.col(record_col)).alias("m"))
        role = F.col("m")["role"]
        wc = F.coalesce(word_count(F.col("m")["content"]), F.lit(0))
    else:
        m = records.select(*group_cols, F.explode(messages_of(F.col(record_col))).alias("m"))
        role = _as_string(_field(F.col("m"), "role"))
        c = _field(F.col("m"), "content")
        wc = F.when(_is_none(c), F.lit(0)).when(_is_string(c), word_count(_as_string(c)))
    return (
        m.select(*group_cols, role.alias("role"), wc.cast("bigint").alias("wc"))
        .filter(F.col("role").isin(STAT_ROLES) & F.col("wc").isNotNull())
    )


def _stats_aggs() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.min("wc").alias("min_words"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY wc DESC)").cast("bigint").alias("median_words"),
        F.max("wc").alias("max_words"),
        F.expr("sum(wc) div count(1)").cast("bigint").alias("mean_words"),
    ]


def length_stats(
    records: DataFrame,
    record_col: str = "record",
    group_cols: Sequence[str] = (),
    groups: DataFrame | None = None,
) -> DataFrame:
    """Per role (user, assistant): n, min, upper median ``sorted[n//2]``, max,
    floor mean. A role with no messages has n 0 and NULL stats.

    min/max/sum/count aggregate partially map-side; the exact median keeps one
    count per distinct word count (``percentile_disc``), so a role holding most
    rows does not pull them into one task. With ``group_cols`` the stats are per
    group; ``groups`` (one row per group) may be passed to reuse a frame the
    caller already has instead of a distinct over the records.
    """
    wc = message_words(records, record_col, group_cols)
    stats = wc.groupBy(*group_cols, "role").agg(*_stats_aggs())
    roles = F.explode(F.array(*[F.lit(r) for r in STAT_ROLES])).alias("role")
    if group_cols:
        if groups is None:
            groups = records.select(*group_cols).distinct()
        # every group x the two stats roles: explode a 2-element literal per group
        frame = groups.select(*group_cols, roles)
    else:
        frame = records.sparkSession.range(1).select(roles)
    return frame.join(stats, [*group_cols, "role"], "left").select(
        *group_cols,
        "role",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        "min_words",
        "median_words",
        "max_words",
        "mean_words",
    )


def stats_text(n: Column, mn: Column, md: Column, mx: Column, mean: Column) -> Column:
    return F.when(n == 0, F.lit("no data")).otherwise(
        F.format_string("min=%d, median=%d, max=%d, mean=%d", mn, md, mx, mean)
    )


def message_rows(validated: DataFrame, file_col: str, record_col: str) -> DataFrame:
    """One row per message (one row for a record without messages):
    ``file, first, bad, role, wc`` where ``first`` marks one row per record and
    ``wc`` is set only for the stats roles."""
    bad = F.size("problems") > 0
    # lines that are not JSON or too long (``valid`` and ``too_long`` columns from
    # ``parse_lines``) are counted apart and never as records
    ok = F.col("valid") if "valid" in validated.columns else F.lit(True)
    long = F.col("too_long") if "too_long" in validated.columns else F.lit(False)
    validated = validated.select(file_col, record_col, "problems", ok.alias("ok"), long.alias("long"))
    if _is_typed(validated, record_col):
        m = validated.select(file_col, "ok", "long", bad.alias("bad"), F.posexplode_outer(F.col(record_col)).alias("pos", "m"))
        role = F.col("m")["role"]
        wc = F.coalesce(word_count(F.col("m")["content"]), F.lit(0))
    else:
        m = validated.select(
            file_col, "ok", "long", bad.alias("bad"), F.posexplode_outer(messages_of(F.col(record_col))).alias("pos", "m")
        )
        role = _as_string(_field(F.col("m"), "role"))
        c = _field(F.col("m"), "content")
        wc = F.when(_is_none(c), F.lit(0)).when(_is_string(c), word_count(_as_string(c)))
    first = F.col("pos").isNull() | (F.col("pos") == 0)
    return m.select(
        file_col,
        first.alias("first"),
        "ok",
        "long",
        "bad",
        role.alias("role"),
        F.when(role.isin(STAT_ROLES), wc).cast("bigint").alias("wc"),
    )


def validation_summary(
    validated: DataFrame, file_col: str = "file", record_col: str = "record", with_bad_json: bool = False
) -> DataFrame:
    """One row per file: records, invalid records, status, and the word-count
    line per stats role ('no data' when empty).

    One pass: the messages of every record feed a single aggregation with the
    grouping sets ``(file)`` (record counts, from one row per record) and
    ``(file, role)`` (word statistics); a small second aggregation puts each
    file's levels side by side.
    """
    rows = message_rows(validated, file_col, record_col)
    levels = rows.groupingSets([[file_col], [file_col, "role"]], file_col, "role").agg(
        F.grouping_id().alias("level"),
        F.count_if(F.col("first") & F.col("ok")).alias("records"),
        F.count_if(F.col("first") & F.col("ok") & F.col("bad")).alias("invalid"),
        F.count_if(F.col("first") & ~F.col("ok") & ~F.col("long")).alias("bad_json"),
        F.count_if(F.col("first") & F.col("long")).alias("too_long"),
        *_stats_aggs_nullable(),
    )
    per_file = levels.groupBy(file_col).agg(
        F.max(F.when(F.col("level") == 1, F.col("records"))).alias("records"),
        F.max(F.when(F.col("level") == 1, F.col("invalid"))).alias("invalid"),
        F.max(F.when(F.col("level") == 1, F.col("bad_json"))).alias("bad_json"),
        F.max(F.when(F.col("level") == 1, F.col("too_long"))).alias("too_long"),
        *[
            F.max(
                F.when(
                    (F.col("level") == 0) & (F.col("role") == r),
                    stats_text(F.col("n"), F.col("min_words"), F.col("median_words"), F.col("max_words"), F.col("mean_words")),
                )
            ).alias(f"{r}_words")
            for r in STAT_ROLES
        ],
    )
    status = F.when(
        F.col("invalid") > 0, F.format_string("PROBLEMS found in %d records", F.col("invalid"))
    ).otherwise(F.lit("all records valid"))
    return per_file.select(
        file_col,
        F.col("records").cast("bigint"),
        F.col("invalid").cast("bigint"),
        status.alias("status"),
        *[F.coalesce(F.col(f"{r}_words"), F.lit("no data")).alias(f"{r}_words") for r in STAT_ROLES],
        *([F.col(c).cast("bigint") for c in ("bad_json", "too_long")] if with_bad_json else []),
    )


def _stats_aggs_nullable() -> list[Column]:
    """Word statistics over ``wc`` ignoring NULLs (rows outside the stats roles)."""
    return [
        F.count("wc").alias("n"),
        F.min("wc").alias("min_words"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY wc DESC)").cast("bigint").alias("median_words"),
        F.max("wc").alias("max_words"),
        F.expr("sum(wc) div count(wc)").cast("bigint").alias("mean_words"),
    ]


def default_token_count(messages: Column) -> Column:
    """Words of the rendered conversation (the template's markers included)."""
    return word_count(render_prompt(messages, add_generation_prompt=False))


def token_budget(
    records: DataFrame,
    budget: int = 1536,
    group_col: str = "split",
    messages_col: str = "messages",
    counter: Callable[[Column], Column] = default_token_count,
) -> DataFrame:
    """Per group: records, records over ``budget`` tokens, and their share. The
    counter is pluggable; the default counts words, ``token_limit.tokenizer_counter``
    the tokens of a tokenizer file."""
    # counted once per record, then aggregated
    counted = records.select(group_col, F.explode(F.array(counter(F.col(messages_col)))).alias("__tokens"))
    agg = counted.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("__tokens") > F.lit(budget)).alias("over_budget"),
        F.max("__tokens").alias("max_tokens"),
    )
    return agg.select(
        group_col,
        F.col("records").cast("bigint"),
        F.col("over_budget").cast("bigint"),
        F.col("max_tokens").cast("bigint"),
        (F.col("over_budget").cast("double") / F.col("records")).alias("share_over"),
    )
