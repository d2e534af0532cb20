"""Registered queries: one per operator of the blueprint, over the driver tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame whose columns match the
oracle SQL in ``plans.oracle``. Order-dependent operators that must find a
threshold (cap, split, subsample, head) run their bounded selection passes when
called; the returned frame is lazy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairforge.functions import text as T
from pairforge.operators.chat import CHATML, HEADERS, INST, TURNS, format_chat, prompt_messages, render_prompt, to_jsonl
from pairforge.operators.pairs import (
    clean_pair_columns,
    json_array_source,
    parquet_source,
    prepare_pairs,
    source_counts,
    union_sources,
)
from pairforge.operators.sampling import group_split, leaked_groups, shuffle_key, subsample_k, train_val_split, with_position
from pairforge.plans import build as B
from pairforge.plans import report_ledger
from pairforge.operators.evaluate import eval_length, eval_numbers, eval_readability
from pairforge.operators.rewrite import SENTENCE_LINES, SQUEEZE, batch_rewrite, compare_rewrites, guard_input, sentence_lines_factory, squeeze_factory
from pairforge.operators.rewrite_job import budgeted, rewrite_job, rewritten
from pairforge.operators.token_limit import token_limit
from pairforge.operators.validate import (
    invalid_records,
    length_stats,
    problem_head,
    problem_text,
    token_budget,
    validate_records,
    validation_summary,
)
from pairforge.plans.check import check_split_files, first_record
from pairforge.plans.subsample import subsample_files
from pairforge.plans.views import chat_records, pairs_conv, pairs_doc, table
from pairforge.sources.jsonl import INVALID, bad_lines, line_numbers, parse_lines, read_lines
from pairforge.streaming.validate_stream import validate_files_once
from pairforge.session import drop_scratch, scratch_path, side_table
from pairforge.sources.parquet import pick_columns, scan_ordered
from pairforge.sources.splits import read_json_array, read_splits, write_json_arrays, write_splits
from pairforge.sources.versions import publish, resolve

Query = Callable[[SparkSession, str], DataFrame]
SUBSAMPLE_SIZES = {"train": 300, "val": 50}
CAP_TEST = {"conv": 100, "doc": 200}
FILES_CAP = 120
BATCH_WORDS = 20_000  # padded words of one call of a rewriter
ARRAY_ROWS = 10_000  # objects of one JSON array file
COMPRESSION = "gzip"  # of split files


def _flat_messages(df: DataFrame, n: int, keep: list[str]) -> DataFrame:
    cols = [*keep, F.size("messages").cast("bigint").alias("n_messages")]
    for i in range(n):
        cols += [F.col("messages")[i]["role"].alias(f"role_{i}"), F.col("messages")[i]["content"].alias(f"content_{i}")]
    return df.select(*cols)


# ---- text scalars -------------------------------------------------------

def q_strip_text(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.posexplode(F.split("text", r"\.", -1)).alias("pos", "piece")).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), T.py_strip("piece").alias("stripped")
    )


def q_truncate_text(spark, sf):
    docs = table(spark, sf, "documents")
    cut = T.truncate(T.py_strip("text"), B.TRUNCATE_EXAMPLE)
    return docs.select(
        "doc_id",
        cut.alias("truncated"),
        T.char_length(cut).cast("bigint").alias("n_chars"),
        (T.py_strip(cut) != cut).alias("ends_in_ws"),
    )


def q_word_count(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", T.word_count("text").cast("bigint").alias("words"))


def q_pick_columns(spark, sf):
    pd_ = pairs_doc(spark, sf)
    inp, out = pick_columns(pd_.columns)
    return pd_.select(
        "doc_id",
        F.lit(inp).alias("input_col"),
        F.lit(out).alias("output_col"),
        F.col(inp).alias("abstract"),
        F.col(out).alias("plain_summary"),
    )


def q_filter_pairs(spark, sf):
    """Length test on every candidate pair of both sources (kept or not)."""
    parts = []
    for src in (B.conv_source(spark, sf), B.doc_source(spark, sf)):
        a, b = clean_pair_columns(src.frame, None, src.truncate)
        key = F.concat_ws(":", F.lit(src.name), *[F.col(k).cast("string") for k in src.key_cols])
        parts.append(src.frame.select(key.alias("pair_key"), a, b))
    df = parts[0].unionByName(parts[1])
    return df.select(
        "pair_key",
        T.char_length("abstract").cast("bigint").alias("abstract_chars"),
        T.char_length("plain_summary").cast("bigint").alias("plain_chars"),
        ((T.char_length("abstract") > 50) & (T.char_length("plain_summary") > 50)).alias("keep"),
    )


def q_prepare_pairs(spark, sf):
    a = prepare_pairs(B.conv_source(spark, sf), 0)
    b = prepare_pairs(B.doc_source(spark, sf), 1)
    return a.unionByName(b)


def q_scan_ordered(spark, sf):
    df = scan_ordered(spark, [f"{sf}/documents.parquet"], columns=["doc_id", "lang"])
    return df.select(F.col("path_ord").cast("int"), F.col("row_index").cast("bigint"), "doc_id", "lang")


# ---- order-dependent ----------------------------------------------------

def q_cap_pairs(spark, sf):
    """Both sources capped below their size (100 and 200 pairs): counted in one
    job, thresholds selected from the persisted keys."""
    srcs = [B.conv_source(spark, sf, cap=CAP_TEST["conv"]), B.doc_source(spark, sf, cap=CAP_TEST["doc"])]
    return union_sources(srcs).select("source", "pair_key", "o_part", "o_row")


def _union(spark, sf, checkpoint: bool = False):
    u = union_sources(B.default_sources(spark, sf))
    return B.materialize(u) if checkpoint else u


def q_union_sources(spark, sf):
    return _union(spark, sf)


def q_source_counts(spark, sf):
    srcs = B.default_sources(spark, sf)
    return source_counts(union_sources(srcs), srcs)


def q_shuffle_seeded(spark, sf):
    """The permutation with each row's place in it."""
    h = shuffle_key(_union(spark, sf).select("pair_key"), B.SEED)
    return with_position(h, ["shuffle_hash", "pair_key"]).select("pair_key", "shuffle_hash", "position")


def q_split_order(spark, sf):
    """The written split files, line by line in file order."""
    res = B.build_records(B.default_sources(spark, sf))
    out = scratch_path(spark, "splits")
    write_splits(res.records, out, compression=COMPRESSION)
    lines = read_lines(spark, out)
    numbered = line_numbers(lines, lines)
    return numbered.join(_rows_before(lines, "split"), "file_path").select("split", (F.col("before") + F.col("line_no") - 1).alias("position"), "value")


def _rows_before(rows: DataFrame, *within: str) -> DataFrame:
    """(file_path, before): the rows of the files before each one (of the same
    ``within``), a row per file."""
    files = rows.groupBy(*within, "file_path").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(*within).orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1))
    return side_table(files.select("file_path", F.coalesce(before, F.lit(0)).alias("before")), "rows-before")


def _in_ranges(df: DataFrame, *order: str) -> DataFrame:
    """Range partitioned and sorted: file names, then rows, follow the order."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def q_file_sources(spark, sf):
    """File sources in order: a folder of sorted files, a partitioned folder, a
    folder that lacks the text columns; once capped and once whole, beside a
    disabled source, a folder of JSON arrays and a missing one. All rows of both
    pair views go into the files."""
    root = scratch_path(spark, "files")
    conv = pairs_conv(spark, sf).withColumnsRenamed({"query": "Query", "answer": "Answer"})
    third = F.pmod("conv_id", F.lit(3))
    _in_ranges(conv.filter(third == 0), "conv_id", "turn").write.parquet(f"{root}/a")
    b = conv.filter(third == 1).withColumn("p", F.pmod("turn", F.lit(4)))
    _in_ranges(b, "p", "conv_id", "turn").write.partitionBy("p").parquet(f"{root}/b")
    conv.filter(third == 2).select("conv_id", "turn").write.parquet(f"{root}/c")
    docs = pairs_doc(spark, sf).select("doc_id", F.col("Source").alias("abstract"), F.col("Target").alias("plain_summary"))
    write_json_arrays(docs, "doc_id", f"{root}/array", ARRAY_ROWS)
    paths = [f"{root}/a", f"{root}/b", f"{root}/c"]
    srcs = [
        parquet_source(spark, "files", paths, cap=FILES_CAP),
        parquet_source(spark, "whole", paths),
        parquet_source(spark, "off", paths, enabled=False),
        json_array_source(spark, "array", f"{root}/array"),
        json_array_source(spark, "none", f"{root}/none"),
    ]
    return union_sources([s for s in srcs if s is not None]).select("source", "abstract", "plain_summary")


def q_mixed_schemas(spark, sf):
    """A folder whose files differ: those that come first lack the text columns, the
    next name them, in others the input is a number, a name has another case, or
    the output is missing. Texts of over 4 characters are kept."""
    root = scratch_path(spark, "mixed")
    conv = pairs_conv(spark, sf)
    number = (F.col("conv_id") * 1_000_000 + F.col("turn") + 10_000).alias("Query")
    shapes = [
        ["conv_id", F.lit(1.5).alias("score")],
        ["conv_id", F.col("query").alias("Query"), F.col("answer").alias("Answer")],
        [F.col("conv_id").cast("string"), number, F.col("answer").alias("Answer")],
        [F.col("query").alias("QUERY"), F.col("answer").alias("Answer"), F.lit("x").alias("score")],
        ["conv_id", F.col("query").alias("Query")],
    ]
    for k, shape in enumerate(shapes):
        conv.filter(F.pmod("conv_id", F.lit(len(shapes))) == k).select(*shape).write.parquet(f"{root}/part={k}")
    return union_sources([parquet_source(spark, "mixed", [root])], min_chars=4).select("abstract", "plain_summary")


def q_json_array_split(spark, sf):
    """Documents written as JSON arrays, each file read back by many tasks."""
    root = scratch_path(spark, "arrays")
    docs = table(spark, sf, "documents").select("doc_id", F.col("doc_id").alias("id"), "text")
    write_json_arrays(docs, "doc_id", root, ARRAY_ROWS, "none")
    rows = read_json_array(spark, root, "id bigint, text string")
    return rows.join(_rows_before(rows), "file_path").select("id", "text", (F.col("before") + F.col("element")).alias("position"))


def q_bad_lines(spark, sf):
    """Lines of written files that are not JSON, with their line numbers counted
    through the files: every fifth ``props`` loses its last character, every seventh
    is blank."""
    out = scratch_path(spark, "hostile")
    _in_ranges(hostile_props(spark, sf), "line_no").select("value").write.text(out)
    bad = bad_lines(spark, out).filter(F.col("status") == INVALID).join(_rows_before(read_lines(spark, out)), "file_path")
    return bad.select((F.col("before") + F.col("line_no")).alias("line_no"), "value")


def hostile_props(spark, sf):
    ev = table(spark, sf, "events")
    n = F.col("event_id")
    value = F.when(n % 7 == 3, F.lit(" \t")).when(n % 5 == 2, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    return ev.select((n + 1).alias("line_no"), value.alias("value"))


def q_validate_hostile(spark, sf):
    """Every document as a chat record, some without ``messages``, with a blank
    or missing content, or in the wrong order, by a rule on doc_id."""
    docs = table(spark, sf, "documents")
    n = F.col("doc_id")

    def message(role, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    user, reply = message("user", F.when(n % 5 == 1, F.lit(" \n")).otherwise(F.col("text"))), message("assistant", F.when(n % 5 != 2, F.col("text")))
    whole = F.to_json(F.struct(F.array(message("system", F.lit("s")), user, reply).alias("messages")))
    turned = F.to_json(F.struct(F.array(message("system", F.lit("s")), reply, user).alias("messages")))
    keyless = F.to_json(F.struct(F.col("text").alias("body")))
    lines = docs.select("doc_id", F.when(n % 5 == 3, keyless).when(n % 5 == 4, turned).otherwise(whole).alias("value"))
    v = validate_records(parse_lines(lines))
    return v.select("doc_id", F.size("problems").cast("bigint").alias("n_problems"), problem_text(F.col("problems")).alias("problems"))


def q_report_empty_val(spark, sf):
    """Build with an empty validation split, write pairs and files, check them."""
    root = scratch_path(spark, "report")
    return B.run_pipeline(spark, B.default_sources(spark, sf), f"{root}/splits", f"{root}/pairs", val_ratio=0.0, compression=COMPRESSION).select("file", "records", "invalid", "status")


def q_first_record(spark, sf):
    """The first training line of the written files, in full."""
    res = B.build_records(B.default_sources(spark, sf))
    out = scratch_path(spark, "splits")
    write_splits(res.records, out, compression=COMPRESSION)
    return first_record(spark, out)


def q_train_val_split(spark, sf):
    return train_val_split(_union(spark, sf, checkpoint=True), B.VAL_RATIO, B.SEED).select("pair_key", "split")


def q_group_split(spark, sf):
    """Pairs of one input text stay on one side; sizes are counted in words."""
    words = T.word_count("abstract") + T.word_count("plain_summary")
    split = group_split(_union(spark, sf, checkpoint=True), B.VAL_RATIO, B.SEED, ("abstract",), weight=words)
    return split.select("pair_key", "group_key", "split")


def q_split_leakage(spark, sf):
    """Input texts on both sides of the split by rows and of the split by groups."""
    pairs = _union(spark, sf, checkpoint=True)
    by_row = leaked_groups(train_val_split(pairs, B.VAL_RATIO, B.SEED), ("abstract",))
    by_group = leaked_groups(group_split(pairs, B.VAL_RATIO, B.SEED, ("abstract",)), ("abstract",))
    return by_row.withColumn("unit", F.lit("row")).unionByName(by_group.withColumn("unit", F.lit("group")))


def q_split_counts(spark, sf):
    res = B.build_records(B.default_sources(spark, sf))
    return B.split_counts(res.records)


def q_subsample_k(spark, sf):
    split = train_val_split(_union(spark, sf, checkpoint=True), B.VAL_RATIO, B.SEED)
    return subsample_k(split, SUBSAMPLE_SIZES, B.SEED).select("pair_key", "split")


def q_preview_pair(spark, sf):
    order = F.struct("source_ord", "o_part", "o_file", "o_row")
    row = F.struct("source", "pair_key", "abstract", "plain_summary")
    head = _union(spark, sf).agg(F.min_by(row, order).alias("r")).filter("r IS NOT NULL").select("r.*")
    return head.select(
        "source",
        "pair_key",
        T.preview("abstract").alias("abstract_preview"),
        T.preview("plain_summary").alias("plain_preview"),
    )


# ---- chat records ---------------------------------------------------------

def q_format_chat(spark, sf):
    return _flat_messages(format_chat(_union(spark, sf)), 3, ["pair_key"])


def q_format_prompt(spark, sf):
    docs = table(spark, sf, "documents")
    return _flat_messages(docs.select("doc_id", prompt_messages(F.col("text")).alias("messages")), 2, ["doc_id"])


def q_render_prompt(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", render_prompt(prompt_messages(F.col("text")), CHATML).alias("prompt"))


def q_render_templates(spark, sf):
    """The first three turns from each turn on, whatever their roles, as four model
    families write them."""
    recs = chat_records(spark, sf)
    named = {"chatml": CHATML, "headers": HEADERS, "turns": TURNS, "inst": INST}
    return recs.select("conv_id", "start", *[render_prompt(F.col("messages"), t).alias(n) for n, t in named.items()])


def q_to_jsonl(spark, sf):
    return to_jsonl(format_chat(_union(spark, sf)), keep=("pair_key",))


def q_split_roundtrip(spark, sf):
    res = B.build_records(B.default_sources(spark, sf))
    out = scratch_path(spark, "splits")
    write_splits(res.records, out, compression=COMPRESSION)
    back = read_splits(spark, out)
    return _flat_messages(back, 3, ["split"])


# ---- validation ---------------------------------------------------------

def q_jsonl_parse(spark, sf):
    """``events.props`` as the lines of a JSON-lines file (line = event_id + 1),
    some of them cut or blank."""
    p = parse_lines(hostile_props(spark, sf))
    return p.select("line_no", "valid", F.try_variant_get("record", "$.k", "bigint").alias("k"))


def _chat_validated(spark, sf):
    """chat_records -> JSON lines -> strict parse -> problems (the reference's
    validation path: records are read back from their JSON text)."""
    lines = to_jsonl(chat_records(spark, sf), keep=("conv_id", "start"))
    return validate_records(parse_lines(lines))


def q_validate_records(spark, sf):
    v = _chat_validated(spark, sf)
    return v.select(
        "conv_id", "start", F.size("problems").cast("bigint").alias("n_problems"), problem_text(F.col("problems")).alias("problems")
    )


def q_invalid_records(spark, sf):
    v = invalid_records(_chat_validated(spark, sf))
    return v.select("conv_id", "start", problem_text(F.col("problems")).alias("problems"))


def q_problem_head(spark, sf):
    return problem_head(_chat_validated(spark, sf), ["conv_id", "start"], 5).select("idx", "problems", "more")


def q_length_stats(spark, sf):
    return length_stats(_chat_validated(spark, sf))


def q_validation_summary(spark, sf):
    res = B.build_records(B.default_sources(spark, sf))
    # typed records (as built) and parsed JSON lines are checked in their own form
    splits = validate_records(res.records.select(F.col("split").alias("file"), F.col("messages").alias("record")))
    chat = _chat_validated(spark, sf).select(F.lit("chat").alias("file"), "record", "problems")
    return validation_summary(splits, "file").unionByName(validation_summary(chat, "file"))


def q_validate_files(spark, sf):
    """Build, write the split JSON lines, and validate the written files."""
    res = B.build_records(B.default_sources(spark, sf))
    out = scratch_path(spark, "splits")
    write_splits(res.records, out, compression=COMPRESSION)
    return check_split_files(spark, out)


def q_publish_versions(spark, sf):
    """Splits published with a tenth, then with a fifth of validation; in between a
    write that fails after its files are there. Records of both versions."""
    out = f"{scratch_path(spark, 'versions')}/splits"
    sources = B.default_sources(spark, sf)
    pairs, path = B.materialize_at(union_sources(sources))  # read by both builds
    B.run_build(spark, sources, out, val_ratio=0.1, versioned=True, pairs=pairs, compression=COMPRESSION)

    def failing(folder: str) -> None:
        pairs_conv(spark, sf).select("query").write.text(folder)
        raise InterruptedError

    try:
        publish(spark, out, failing)
    except InterruptedError:
        pass
    B.run_build(spark, sources, out, val_ratio=0.2, versioned=True, pairs=pairs, compression=COMPRESSION)
    drop_scratch(spark, path)
    parts = [read_splits(spark, resolve(spark, out, v)).select(F.lit(v).cast("bigint").alias("version"), "split", F.size("messages").alias("n")) for v in (1, 2)]
    return parts[0].unionByName(parts[1]).groupBy("version", "split").agg(F.count(F.lit(1)).alias("records"), F.sum("n").alias("messages"))


def q_report_incremental(spark, sf):
    """The report after the splits of a second source have joined those of the first:
    the second update reads the new files only."""
    root = scratch_path(spark, "incremental")
    for k, source in enumerate((B.conv_source(spark, sf), B.doc_source(spark, sf))):
        records = B.build_records([source]).records.select("split", "messages")
        records.write.mode("append").partitionBy("split").json(f"{root}/splits")
        files = report_ledger.update(spark, f"{root}/splits", f"{root}/ledger")
        if k and any(f in before for f in files):
            raise RuntimeError("a file that has not changed was read again")
        before = set(files)
    return report_ledger.report(spark, f"{root}/splits", f"{root}/ledger")


def q_subsample_files(spark, sf):
    """Build, write the split JSON lines, keep 300 train / 50 val lines of the
    files (seeded, by content), and read the sample back."""
    res = B.build_records(B.default_sources(spark, sf))
    out = scratch_path(spark, "splits")
    write_splits(res.records, out, compression=COMPRESSION)
    small = scratch_path(spark, "splits-sample")
    subsample_files(spark, out, small, SUBSAMPLE_SIZES, B.SEED)
    return spark.read.text(small).select("split", "value")


def q_stream_validate(spark, sf):
    """Build and write the split JSON lines, then check them with the streaming
    validator (every file once) and count records and invalid records per split."""
    res = B.build_records(B.default_sources(spark, sf))
    out = scratch_path(spark, "splits")
    write_splits(res.records, out, compression=COMPRESSION)
    return validate_files_once(spark, out, scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")).select(
        "split", F.col("records").cast("bigint"), F.col("invalid").cast("bigint")
    )


def q_token_budget(spark, sf):
    res = B.build_records(B.default_sources(spark, sf))
    return token_budget(res.records, 1536)


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def q_token_limit(spark, sf):
    """Where the sequence limit cuts the prompt of each document, in the tokens of a
    public tokenizer."""
    docs = table(spark, sf, "documents")
    out = token_limit(docs.select("doc_id", prompt_messages(F.col("text")).alias("messages")), tokenizer_file(), B.SEQUENCE_LIMIT)
    return out.select("doc_id", "n_tokens", "lost_tokens", "cut", F.col("lost")[1]["lost_chars"].alias("lost_user_chars"))


# ---- rewriting and evaluation ----------------------------------------------

def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def q_guard_input(spark, sf):
    """Every ninth text is replaced by white space, so that the guard has work."""
    blank = F.when(F.pmod("doc_id", F.lit(9)) == 4, F.lit(" \n\t")).otherwise(F.col("text"))
    return guard_input(_docs(spark, sf).withColumn("text", blank)).select("doc_id", "needs_rewrite", "before", "after")


def q_batch_rewrite(spark, sf):
    return batch_rewrite(_docs(spark, sf), squeeze_factory).select("doc_id", "rewrite")


def q_resume_rewrite(spark, sf):
    """A rewrite in batches of bounded size, stopped after its first wave. Texts of
    every tenth document have changed when it goes on, and are back in the end."""
    docs, out = _docs(spark, sf), f"{scratch_path(spark, 'rewrite')}/job"
    changed = docs.withColumn("text", F.when(F.pmod("doc_id", F.lit(10)) == 3, F.concat("text", F.lit(" Changed."))).otherwise(F.col("text")))
    rewrite_job(docs, out, budgeted(squeeze_factory, BATCH_WORDS), shards=16, wave=8, most_waves=1)
    rewrite_job(changed, out, budgeted(squeeze_factory, BATCH_WORDS), shards=16, wave=8)
    rewrite_job(docs, out, squeeze_factory, shards=16, wave=8)
    return rewritten(spark, out)


def q_compare_rewrites(spark, sf):
    return compare_rewrites(_docs(spark, sf), squeeze_factory, sentence_lines_factory).select("doc_id", "before", "after")


def _compared(spark, sf):
    return compare_rewrites(_docs(spark, sf), SQUEEZE, SENTENCE_LINES)


def q_eval_length(spark, sf):
    return eval_length(_compared(spark, sf))


def q_eval_numbers(spark, sf):
    return eval_numbers(_compared(spark, sf))


def q_eval_readability(spark, sf):
    return eval_readability(_compared(spark, sf))


QUERIES: dict[str, Query] = {
    "strip_text": q_strip_text,
    "truncate_text": q_truncate_text,
    "word_count": q_word_count,
    "pick_columns": q_pick_columns,
    "filter_pairs": q_filter_pairs,
    "prepare_pairs": q_prepare_pairs,
    "scan_ordered": q_scan_ordered,
    "cap_pairs": q_cap_pairs,
    "union_sources": q_union_sources,
    "source_counts": q_source_counts,
    "shuffle_seeded": q_shuffle_seeded,
    "split_order": q_split_order,
    "file_sources": q_file_sources,
    "mixed_schemas": q_mixed_schemas,
    "json_array_split": q_json_array_split,
    "bad_lines": q_bad_lines,
    "validate_hostile": q_validate_hostile,
    "report_empty_val": q_report_empty_val,
    "first_record": q_first_record,
    "train_val_split": q_train_val_split,
    "group_split": q_group_split,
    "split_leakage": q_split_leakage,
    "split_counts": q_split_counts,
    "subsample_k": q_subsample_k,
    "preview_pair": q_preview_pair,
    "format_chat": q_format_chat,
    "format_prompt": q_format_prompt,
    "render_prompt": q_render_prompt,
    "render_templates": q_render_templates,
    "to_jsonl": q_to_jsonl,
    "split_roundtrip": q_split_roundtrip,
    "jsonl_parse": q_jsonl_parse,
    "validate_records": q_validate_records,
    "invalid_records": q_invalid_records,
    "problem_head": q_problem_head,
    "length_stats": q_length_stats,
    "validation_summary": q_validation_summary,
    "validate_files": q_validate_files,
    "publish_versions": q_publish_versions,
    "report_incremental": q_report_incremental,
    "subsample_files": q_subsample_files,
    "stream_validate": q_stream_validate,
    "token_budget": q_token_budget,
    "token_limit": q_token_limit,
    "guard_input": q_guard_input,
    "batch_rewrite": q_batch_rewrite,
    "resume_rewrite": q_resume_rewrite,
    "compare_rewrites": q_compare_rewrites,
    "eval_length": q_eval_length,
    "eval_numbers": q_eval_numbers,
    "eval_readability": q_eval_readability,
}
