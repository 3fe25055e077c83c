"""The registered queries: every operator over the whole of the given tables.

Events are one long token sequence (position ``event_id``, token ``user_id``), orders another one
that must first be numbered, documents are many word sequences, and conversations are sequences of
turns. ``embeddings`` holds the vector of each vocabulary index.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenwin.functions import vectors
from tokenwin.functions.positions import positional_encoding
from tokenwin.operators import evaluate, features, job_metrics, training, vocab, windows
from tokenwin.operators.embed_learning import cooccurrence_counts, encoded_windows, learn_embeddings
from tokenwin.operators.split import split_examples
from tokenwin.operators.vector_table import VECTOR_BYTES
from tokenwin.shared import new_path, write_shared
from tokenwin.sources import epoch_table, event_log, models
from tokenwin.sources.epoch_table import RECORDED_SCHEMA
from tokenwin.sources.event_log import read_event_log
from tokenwin.sources.spread import spread
from tokenwin.sources.tokens import read_token_ids, tokens_from_arrays, tokens_from_table

WINDOW, STRIDE = 64, 32
# Windows with gaps between them, so that some tokens stay without an index.
SPARSE_WINDOW, SPARSE_STRIDE = 4, 97
DIGITS = 6
CHECKSUM_DIGITS = 4
# Rows of one file of a written event log.
LOG_ROWS = 1 << 20

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def event_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_from_table(table(spark, sf_dir, "events"), "event_id", "user_id", dense=True)


def order_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_from_table(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey")


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split(F.trim("text"), r"\s+")
    return table(spark, sf_dir, "documents").select("doc_id", words.alias("words"))


def vector_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return vecs.select(F.col("vec_id").alias("idx"), F.col("embedding").alias("vec"))


def rounded(c: Column | str) -> Column:
    # Adding 0.0 turns a negative zero into a plain one.
    return F.round(c, DIGITS) + F.lit(0.0)


def checksum(array: Column | str, length: int) -> Column:
    """Weighted sum of an array that any change of order would alter.

    Weights end at 1 and fewer digits are kept, as sums of thousands of cells differ in the last
    bits with the order of addition.
    """
    weights = F.sequence(F.lit(1), F.lit(length))
    return F.round(vectors.dot(array, weights) / length, CHECKSUM_DIGITS) + F.lit(0.0)


def joined(array: Column | str, by: str = ",") -> Column:
    array = F.col(array) if isinstance(array, str) else array
    return F.array_join(array.cast("array<string>"), by)


# Sources


def q_read_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-text")
    events = table(spark, sf_dir, "events")
    events.orderBy("event_id").select(F.col("user_id").cast("string")).write.text(path)
    return read_token_ids(spark, path)


def q_read_token_text_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with blanks and signs around the number, empty lines, and bad ones that are skipped."""
    path = new_path(spark, "token-text")
    user = F.col("user_id").cast("string")
    line = (
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("\t "), user, F.lit(" \x0b")))
        .when(F.col("event_id") % 5 == 1, F.concat(F.lit("x"), user))
        .when(F.col("event_id") % 5 == 2, F.lit("  "))
        .when(F.col("event_id") % 5 == 3, F.concat(F.lit("+"), user))
        .otherwise(user)
    )
    table(spark, sf_dir, "events").orderBy("event_id").select(line.alias("value")).write.text(path)
    return read_token_ids(spark, path, on_error="skip")


def q_tokens_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").alias("size"))
    return tokens_from_table(turns, "turn", "size", "conv_id").select(
        "seq_id", "pos", F.col("token").cast("bigint").alias("token")
    )


def q_tokens_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_tokens(spark, sf_dir)


# Windows


def q_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_count(event_tokens(spark, sf_dir), WINDOW, STRIDE)


def q_doc_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = tokens_from_arrays(document_words(spark, sf_dir), "doc_id", "words")
    return windows.window_count(tokens, WINDOW, STRIDE)


def q_window_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_cells(event_tokens(spark, sf_dir), WINDOW, STRIDE)


def q_window_cells_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_cells(order_tokens(spark, sf_dir), SPARSE_WINDOW, SPARSE_STRIDE)


def q_window_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = windows.window_pairs(event_tokens(spark, sf_dir), WINDOW, STRIDE)
    return pairs.select("seq_id", "k", joined("input").alias("input"), "target")


def q_doc_array_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = windows.array_windows(document_words(spark, sf_dir), "doc_id", "words", WINDOW, STRIDE)
    return pairs.select("seq_id", "k", joined("input", " ").alias("input"), "target")


def q_doc_window_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = tokens_from_arrays(document_words(spark, sf_dir), "doc_id", "words")
    pairs = windows.window_pairs(tokens, WINDOW, STRIDE)
    return pairs.select("seq_id", "k", joined("input", " ").alias("input"), "target")


def q_target_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.target_pairs(windows.window_pairs(event_tokens(spark, sf_dir), WINDOW, STRIDE))


def q_window_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = windows.window_inputs(windows.window_pairs(event_tokens(spark, sf_dir), WINDOW, STRIDE))
    return inputs.select("seq_id", "k", F.size("input").alias("places"), joined("input").alias("input"))


def q_window_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = windows.window_targets(event_tokens(spark, sf_dir), WINDOW, STRIDE)
    return windows.window_labels(labels.withColumnRenamed("token", "target"))


# Vocabulary


def _events_and_vocab(
    spark: SparkSession, sf_dir: str, w: int = WINDOW, s: int = STRIDE
) -> tuple[DataFrame, DataFrame]:
    tokens = windows.with_length(event_tokens(spark, sf_dir))
    return tokens, vocab.build_vocab(tokens, w, s)


def q_distinct_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocab.distinct_tokens(event_tokens(spark, sf_dir), WINDOW, STRIDE)


def q_vocab_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_and_vocab(spark, sf_dir)[1]


def q_vocab_index_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocab.build_vocab(order_tokens(spark, sf_dir), SPARSE_WINDOW, SPARSE_STRIDE)


def q_doc_vocab_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = tokens_from_arrays(document_words(spark, sf_dir), "doc_id", "words")
    return vocab.build_vocab(tokens, WINDOW, STRIDE)


def q_encode_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, names = _events_and_vocab(spark, sf_dir)
    return vocab.encode_windows(tokens, names, WINDOW, STRIDE)


def q_lookup_index_oov(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _events_and_vocab(spark, sf_dir)[1]
    return vocab.lookup_index(order_tokens(spark, sf_dir), names)


def q_decode_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _events_and_vocab(spark, sf_dir)[1]
    return vocab.decode_index(vector_table(spark, sf_dir).select("idx"), names, spread=["idx"])


def q_vocab_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocab.vocab_size(_events_and_vocab(spark, sf_dir)[1])


def q_index_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, names = _events_and_vocab(spark, sf_dir)
    return vocab.index_examples(tokens, names, WINDOW, STRIDE)


def q_unindexed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = windows.with_length(order_tokens(spark, sf_dir))
    names = vocab.build_vocab(tokens, SPARSE_WINDOW, SPARSE_STRIDE)
    return vocab.unindexed_tokens(tokens, names)


# Vector functions, on the target of each window and the input just before it


def _vector_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, names = _events_and_vocab(spark, sf_dir)
    emb = vector_table(spark, sf_dir)
    width = features.embedding_width(emb)
    embedded = windows.window_cells(features.embed_sequence(tokens, names, emb, width), WINDOW, STRIDE)
    cells = embedded.where(F.col("t") >= WINDOW - 1).groupBy("seq_id", "k")
    return cells.agg(
        F.max(F.when(F.col("t") == WINDOW - 1, F.col("vec"))).alias("a"),
        F.max(F.when(F.col("t") == WINDOW, F.col("vec"))).alias("b"),
    )


def q_vector_dot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vector_pairs(spark, sf_dir).select("seq_id", "k", rounded(vectors.dot("a", "b")).alias("dot"))


def q_vector_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vector_pairs(spark, sf_dir).select("seq_id", "k", rounded(vectors.cosine("a", "b")).alias("cosine"))


def q_vector_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vector_pairs(spark, sf_dir).select(
        "seq_id", "k", rounded(vectors.norm("a")).alias("norm"), rounded(vectors.distance("a", "b")).alias("distance")
    )


def q_vector_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _vector_pairs(spark, sf_dir)
    width = features.embedding_width(vector_table(spark, sf_dir))
    return pairs.select(
        "seq_id",
        "k",
        checksum(vectors.add("a", "b"), width).alias("added"),
        checksum(vectors.add("a", vectors.zeros(width)), width).alias("unchanged"),
        checksum(vectors.flatten_rows(F.array("a", "b")), 2 * width).alias("flattened"),
    )


def q_array_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = windows.window_pairs(event_tokens(spark, sf_dir), WINDOW, STRIDE)
    repeated = vectors.as_float(vectors.repeat("target", WINDOW))
    return pairs.select(
        "seq_id",
        "k",
        joined(vectors.take("input", 3)).alias("first_three"),
        vectors.last("input").alias("last_input"),
        F.size(repeated).alias("repeats"),
        rounded(vectors.dot(repeated, "input")).alias("product"),
    )


# Features


def q_embedding_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = vector_table(spark, sf_dir)
    width = features.embedding_width(emb)
    return emb.agg(F.count("*").alias("vectors")).withColumn("width", F.lit(width))


def q_positional_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position value of each event's place in its stride-free window, at a component of its own."""
    width = features.embedding_width(vector_table(spark, sf_dir))
    encoding = positional_encoding(spark, WINDOW, width)
    rows = table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") % WINDOW).cast("int").alias("t"), (F.col("user_id") % width).cast("int").alias("j")
    )
    placed = rows.join(F.broadcast(encoding), "t")
    return placed.select("event_id", "t", "j", rounded(F.get("p", F.col("j"))).alias("value"))


def _embedding_inputs(
    spark: SparkSession, sf_dir: str, w: int = WINDOW, s: int = STRIDE
) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    tokens, names = _events_and_vocab(spark, sf_dir, w, s)
    emb = vector_table(spark, sf_dir)
    return tokens, names, emb, features.embedding_width(emb)


def q_embed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, names, emb, width = _embedding_inputs(spark, sf_dir)
    cells = features.embed_tokens(tokens, names, emb, width, WINDOW, STRIDE)
    return cells.select("seq_id", "k", "t", "token", checksum("vec", width).alias("vec_sum"))


def q_embed_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of the usual windows, with the vocabulary of sparse ones: some are unknown."""
    tokens, names, emb, width = _embedding_inputs(spark, sf_dir, SPARSE_WINDOW, SPARSE_STRIDE)
    targets = features.embed_target(tokens, names, emb, width, WINDOW, STRIDE)
    return targets.select("seq_id", "k", "token", checksum("vec", width).alias("vec_sum"))


def q_position_aware(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, names, emb, width = _embedding_inputs(spark, sf_dir)
    cells = features.embed_tokens(tokens, names, emb, width, WINDOW, STRIDE)
    added = features.add_positions(cells, width, WINDOW)
    return added.select("seq_id", "k", "t", checksum("x", width).alias("x_sum"))


def q_channel_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, names, emb, width = _embedding_inputs(spark, sf_dir)
    windowed = features.window_vectors(tokens, names, emb, width, WINDOW, STRIDE)
    return windowed.select("seq_id", "k", features.channel_first("rows", width).alias("flat")).select(
        "seq_id", "k", F.size("flat").alias("cells"), checksum("flat", width * WINDOW).alias("flat_sum")
    )


def q_training_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, names, emb, width = _embedding_inputs(spark, sf_dir)
    examples = features.training_examples(tokens, names, emb, WINDOW, STRIDE, width)
    return examples.select(
        "seq_id",
        "k",
        F.size("features").alias("cells"),
        checksum("features", width * WINDOW).alias("features_sum"),
        checksum("label", width).alias("label_sum"),
    )


def q_window_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: features of every window, from tokens to sums."""
    tokens, names, emb, width = _embedding_inputs(spark, sf_dir)
    sums = features.window_features(tokens, names, emb, width, WINDOW, STRIDE)
    return sums.select(
        "seq_id",
        "k",
        rounded("total").alias("total"),
        rounded("total_sq").alias("total_sq"),
        rounded("largest").alias("largest"),
        "cells",
    )


# Splitting and evaluation


def q_split_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = windows.window_targets(event_tokens(spark, sf_dir), WINDOW, STRIDE)
    return split_examples(labels, F.concat_ws(":", "seq_id", "k"))


def q_split_examples_95(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = windows.window_targets(event_tokens(spark, sf_dir), WINDOW, STRIDE)
    return split_examples(labels, F.concat_ws(":", "seq_id", "k"), 0.95)


def q_cooccurrence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, names = _events_and_vocab(spark, sf_dir)
    return cooccurrence_counts(encoded_windows(tokens, names, WINDOW, STRIDE))


def q_cooccurrence_counts_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, names = _events_and_vocab(spark, sf_dir, SPARSE_WINDOW, SPARSE_STRIDE)
    return cooccurrence_counts(encoded_windows(tokens, names, WINDOW, STRIDE))


def q_true_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, names, emb, width = _embedding_inputs(spark, sf_dir, SPARSE_WINDOW, SPARSE_STRIDE)
    labels = features.embed_target(tokens, names, emb, width, WINDOW, STRIDE)
    found = evaluate.true_token(labels, emb, ["seq_id", "k"], "vec", width)
    return vocab.decode_index(found, names, ["seq_id", "k"], "true_idx", "true_token")


def _mean_vectors(tokens: DataFrame, names: DataFrame, emb: DataFrame, width: int) -> DataFrame:
    """A plain prediction for each window: the mean vector of its inputs."""
    cells = features.embed_tokens(tokens, names, emb, width, WINDOW, STRIDE)
    means = (F.avg(F.get("vec", F.lit(j))) for j in range(width))
    found = cells.groupBy("seq_id", "k").agg(F.array(*means).alias("prediction"))
    # Adaptive sizing would merge these few bytes into a few tasks, but each row is compared with all vectors.
    return found.repartition(windows.block_partitions(tokens), "seq_id", "k")


def q_nearest_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, names, emb, width = _embedding_inputs(spark, sf_dir)
    queries = _mean_vectors(tokens, names, emb, width)
    near = evaluate.nearest_token(queries, emb, ["seq_id", "k"], "prediction", width=width)
    return near.select("seq_id", "k", "idx", rounded("similarity").alias("similarity"))


def q_nearest_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, names, emb, width = _embedding_inputs(spark, sf_dir)
    labels = features.embed_target(tokens, names, emb, width, WINDOW, STRIDE)
    pairs = _mean_vectors(tokens, names, emb, width).join(
        labels.select("seq_id", "k", F.col("vec").alias("label")), ["seq_id", "k"]
    )
    rows = split_examples(pairs, F.concat_ws(":", "seq_id", "k"))
    scored = evaluate.score_predictions(rows, emb, names, ["seq_id", "k", "split"], width=width)
    return evaluate.accuracy(scored, ["split"]).withColumn("accuracy", rounded("accuracy"))


# Event logs and epoch tables, written from given tables and read back


def _event_log(rows: DataFrame, event: str, **fields: Column) -> DataFrame:
    """Write one JSON line for each row, as Spark's event log has them, and read the log back."""
    path = new_path(rows.sparkSession, "event-log")
    named = [F.lit(event).alias("Event"), *(value.alias(name.replace("_", " ")) for name, value in fields.items())]
    # Compressed, as Spark's own log may be; a gzip file is read by one task, so none has more rows than one should read.
    lines = rows.select(F.to_json(F.struct(*named)).alias("value"))
    lines.write.option("maxRecordsPerFile", LOG_ROWS).text(path, compression="gzip")
    return read_event_log(rows.sparkSession, path)


def _task_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("l_orderkey") * 1000
    info = F.struct(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("Task ID"),
        start.alias("Launch Time"),
        (start + F.col("l_quantity").cast("bigint")).alias("Finish Time"),
        (F.col("l_partkey") % 7 == 0).alias("Failed"),
    )
    read = F.struct(F.col("l_partkey").alias("Remote Bytes Read"), F.col("l_suppkey").alias("Local Bytes Read"))
    measured = F.struct(
        (F.col("l_quantity").cast("bigint") * 2).alias("Executor Run Time"),
        (F.col("l_quantity").cast("bigint") * 1000000).alias("Executor CPU Time"),
        F.col("l_orderkey").alias("Peak Execution Memory"),
        read.alias("Shuffle Read Metrics"),
        F.when(F.col("l_linenumber") > 1, F.struct(F.col("l_partkey").alias("Shuffle Bytes Written"))).alias("Shuffle Write Metrics"),
    )
    lines = table(spark, sf_dir, "lineitem")
    return _event_log(lines, "SparkListenerTaskEnd", Stage_ID=F.col("l_suppkey"), Task_Info=info, Task_Metrics=measured)


def q_task_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log.task_metrics(_task_log(spark, sf_dir))


def q_resource_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = job_metrics.resource_use(event_log.task_metrics(_task_log(spark, sf_dir)), ["stage_id"])
    return used.withColumn("cpu_ratio", rounded("cpu_ratio"))


def q_stage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = F.struct(
        F.col("o_orderkey").alias("Stage ID"),
        (F.col("o_custkey") % 100).alias("Number of Tasks"),
        (F.col("o_orderkey") * 10).alias("Submission Time"),
        (F.col("o_orderkey") * 10 + F.col("o_custkey")).alias("Completion Time"),
    )
    log = _event_log(table(spark, sf_dir, "orders"), "SparkListenerStageCompleted", Stage_Info=info)
    return event_log.stage_metrics(log)


def q_stage_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.concat(F.lit("other,epoch-"), (F.col("o_orderkey") % 5).cast("string"), F.lit(",last"))
    log = _event_log(
        table(spark, sf_dir, "orders"), "SparkListenerJobStart", Job_ID=F.col("o_orderkey"),
        Stage_IDs=F.array(F.col("o_custkey"), F.col("o_custkey") + 1), Properties=F.struct(tags.alias("spark.job.tags")),
    )
    return event_log.stage_epochs(log)


def q_recorded_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of orders as the epochs of a 21-column file."""
    days = table(spark, sf_dir, "orders").groupBy((F.col("o_orderkey") % 50).cast("int").alias("Epoch"))
    per = days.agg(F.count("*").alias("n"), F.sum("o_custkey").alias("c"))
    value = {"TimeStamp": F.col("n"), "TrainingLoss": F.lit(1.0) / (F.col("Epoch") + 1), "TrainingAccuracy": F.col("Epoch") / 64}
    value |= {"ValidationAccuracy": F.col("Epoch") / 128, "failedTaskCount": (F.col("c") % 3).cast("int")}
    columns = [f.name for f in T.StructType.fromDDL(RECORDED_SCHEMA).fields]
    rows = per.select("Epoch", *[value.get(c, F.lit(0)).alias(c) for c in columns[1:]])
    path = new_path(spark, "epochs")
    epoch_table.write_epoch_metrics(rows, path, "csv")
    return epoch_table.summarize_recorded(epoch_table.read_epoch_metrics(spark, path, RECORDED_SCHEMA, "csv"))


def q_epoch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven epochs made of orders, two of them without tasks, with the totals of the tasks of their stages."""
    n, c = F.count("*"), F.sum("o_custkey")
    value = {"duration_ms": n, "training_loss": c / 1024, "gradient_variance": F.lit(float("nan"))}
    days = table(spark, sf_dir, "orders").groupBy((F.col("o_orderkey") % 7).cast("int").alias("epoch"))
    log = days.agg(*[value.get(f.name, F.lit(0.0)).cast(f.dataType).alias(f.name) for f in training.EPOCH_LOG.fields[1:]])
    tasks = job_metrics.tasks_by_epoch(event_log.task_metrics(_task_log(spark, sf_dir)), q_stage_epochs(spark, sf_dir))
    row = job_metrics.epoch_metrics(log, tasks)
    exact = ["training_loss", "avg_task_duration", "cpu_ratio"]
    others = ["duration_ms", "gradient_variance", "total_shuffle_read_bytes", "total_shuffle_write_bytes", "max_task_duration"]
    others += ["min_task_duration", "failed_task_count", "peak_execution_memory", "skewed_task_count"]
    return row.select("epoch", *others, *(rounded(c).alias(c) for c in exact))


# Models whose weights follow from the vectors


def _model_of_vectors(spark: SparkSession, sf_dir: str, width: int, hidden: int) -> training.Model:
    """Weight i is the mean of the cells whose number over all vectors leaves i; it is saved and loaded again."""
    cfg = training.TrainConfig(hidden=hidden)
    model = training.Model.create(width, cfg)
    size = model.state.shape[1]
    cells = vector_table(spark, sf_dir).select("idx", F.posexplode("vec").alias("j", "x"))
    place = F.pmod(F.col("idx") * 64 + F.col("j"), F.lit(size))
    # As many rows as the model has weights, whatever the table.
    means = cells.groupBy(place.alias("i")).agg(F.avg(F.col("x").cast("double")).alias("v")).collect()
    model.state[:] = 0
    for r in means:
        model.state[0][r["i"]] = round(r["v"], DIGITS)
    path = new_path(spark, "model")
    models.save_model(spark, model, path)
    return models.load_model(spark, path)


def q_saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weights of a model that was saved, loaded and saved again, as its folder has them."""
    model = _model_of_vectors(spark, sf_dir, 8, 4)
    path = new_path(spark, "model")
    models.save_model(spark, model, path)
    params = spark.read.parquet(f"{path}/params").where(F.col("param").startswith("weight/"))
    return params.select(F.substring_index("param", "/", -1).alias("param"), "i", rounded("v").alias("v"))


def _vector_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as an example of one place, whose label is the vector itself."""
    vecs = vector_table(spark, sf_dir)
    columns = [F.lit(0).cast("bigint").alias("seq_id"), F.col("idx").alias("k")]
    return vecs.select(*columns, F.col("vec").cast("array<double>").alias("features"), F.col("vec").alias("label"))


def q_model_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _model_of_vectors(spark, sf_dir, 64, 2)
    predicted = training.predict(_vector_examples(spark, sf_dir), model, training.KEY)
    return predicted.select("seq_id", "k", F.size("prediction").alias("cells"), checksum("prediction", 64).alias("prediction_sum"))


def q_model_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the vector nearest to a prediction is that of the label, by the label's class."""
    model = _model_of_vectors(spark, sf_dir, 64, 2)
    labels = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("k"), F.col("label").alias("class"))
    examples = _vector_examples(spark, sf_dir).join(labels, "k")
    emb = vector_table(spark, sf_dir)
    # Tokens are classes of vectors here, so that some predictions are right.
    names = emb.select((F.col("idx") % 5).alias("token"), "idx")
    found = training.compute_accuracy(examples, model, emb, names, by=["class"])
    return found.select("class", "total", "correct", rounded("accuracy").alias("accuracy"))


# Statistics


def q_gradient_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = table(spark, sf_dir, "embeddings").select("label", F.explode("embedding").alias("g"))
    stats = job_metrics.gradient_stats(values, "g", ["label"])
    return stats.select("label", *(rounded(c).alias(c) for c in stats.columns[1:]))


def q_skewed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return job_metrics.skewed_tasks(events, value="value").select("event_id", rounded("value").alias("value"))


def q_skewed_values_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    skewed = job_metrics.skewed_tasks(events, "event_type", "value")
    return skewed.select("event_id", "event_type", rounded("value").alias("value"))


def q_duration_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = job_metrics.duration_stats(table(spark, sf_dir, "events"), ["event_type"], "value")
    return stats.select("event_type", *(rounded(c).alias(c) for c in stats.columns[1:]))


def _line_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items read as tasks: line number for the epoch, quantity and price for bytes."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("epoch"),
        F.col("l_quantity").cast("bigint").alias("shuffle_read_bytes"),
        F.floor("l_extendedprice").cast("bigint").alias("shuffle_write_bytes"),
        (F.col("l_returnflag") == "R").alias("failed"),
    )


def q_shuffle_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_metrics.shuffle_totals(_line_tasks(spark, sf_dir), ["epoch"])


def q_failed_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_metrics.failed_tasks(_line_tasks(spark, sf_dir), ["epoch"])


# Learning; no SQL expresses these


def q_learn_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, names = _events_and_vocab(spark, sf_dir)
    return learn_embeddings(tokens, names, WINDOW, STRIDE)


def q_learn_embeddings_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, names = _events_and_vocab(spark, sf_dir)
    return learn_embeddings(tokens, names, WINDOW, STRIDE, size=16, method="blocks")


def _train(spark: SparkSession, sf_dir: str, epochs: int):
    tokens, names, emb, width = _embedding_inputs(spark, sf_dir)
    examples = features.training_examples(tokens, names, emb, WINDOW, STRIDE, width, packed=True)
    total = windows.window_count(tokens, WINDOW, STRIDE).agg(F.sum("windows")).first()[0]
    model, log = training.train(examples, emb, names, training.TrainConfig(epochs=epochs), total)
    return examples, emb, names, model, log


def q_train_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _train(spark, sf_dir, 2)[-1]


def q_predict_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples, emb, names, model, _ = _train(spark, sf_dir, 1)
    predicted = training.predict(examples, model, [*training.KEY, "label"])
    return evaluate.score_predictions(predicted, emb, names, training.KEY, width=model.width, max_bytes=VECTOR_BYTES)


def q_training_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From events to a saved model and its epoch table, with the accuracy of the model as it is loaded again."""
    tokens, names = _events_and_vocab(spark, sf_dir)
    emb = write_shared(learn_embeddings(tokens, names, WINDOW, STRIDE, size=16), "embeddings")
    examples = features.training_examples(tokens, names, emb, WINDOW, STRIDE, 16, packed=True)
    path = new_path(spark, "job")
    training.train(examples, emb, names, training.TrainConfig(epochs=2), path=path)
    loaded = models.load_model(spark, f"{path}/model-2")
    accuracy = training.compute_accuracy(examples, loaded, emb, names, max_bytes=VECTOR_BYTES).select("accuracy").scalar()
    recorded = epoch_table.read_epoch_metrics(spark, f"{path}/epochs", training.EPOCH_LOG)
    return recorded.withColumn("loaded_accuracy", accuracy)


def queries() -> dict[str, Query]:
    prefix = "q_"
    return {name[len(prefix) :]: f for name, f in globals().items() if name.startswith(prefix)}
