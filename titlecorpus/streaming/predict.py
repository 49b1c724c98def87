"""Continuous title prediction (ST1).

Requests ``(id, abstract)`` arrive as files; each micro-batch is validated,
scored against the static model and written under ``batch_id=<n>`` with
overwrite, so a replayed batch replaces its own output instead of
appending it twice. Invalid rows (a blank text, a NULL id without one, a
malformed JSON line) become error rows: as many rows come out as went in.
The stream never stops on a bad record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pyspark.sql import functions as F

from titlecorpus.functions.text import is_blank, strip_ws
from titlecorpus.operators.batch_udf import predict_with
from titlecorpus.operators.model import generate, load_model, model_version
from titlecorpus.operators.validate import validate_requests
from titlecorpus.schema import INVALID_INPUT_MESSAGE
from titlecorpus.sources import manifest

REQUEST_SCHEMA = "id long, abstract string"


def predict_batch(requests: DataFrame, model: DataFrame, n_model_rows: int | None,
                  max_length: int = 128, num_beams: int = 1, no_repeat_ngram_size: int = 0) -> DataFrame:
    """(id, abstract, predicted_title, error) for one batch of requests, and ``beam`` with more beams than one."""
    # Validation is expressed on the raw columns and evaluated after the
    # id partitioning inside ``generate``; invalid rows have a NULL clean
    # text and so get a NULL title next to their error.
    bad = is_blank("abstract")
    clean = F.when(~bad, strip_ws("abstract"))
    error = F.when(bad, F.lit(INVALID_INPUT_MESSAGE))
    out = generate(requests.select("id", "abstract"), model, max_length=max_length,
                   n_model_rows=n_model_rows, text_col=clean, num_beams=num_beams, no_repeat_ngram_size=no_repeat_ngram_size,
                   keep={"abstract": F.col("abstract"), "error": error})
    return out.select("id", "abstract", "predicted_title", "error", *(["beam"] if num_beams > 1 else []))


def predict_batch_with(requests: DataFrame, predictor, setup=None) -> DataFrame:
    """As ``predict_batch`` with a user predictor ``str -> str`` run in Arrow
    batches; a record whose prediction raises gets an error text. ``setup``
    makes the predictor once per Python worker instead."""
    checked = validate_requests(requests.select("id", "abstract"))
    return predict_with(checked, predictor, setup=setup).select("id", "abstract", "predicted_title", "error")


def batch_model(spark: SparkSession, model_path: str, batch_id: int, output_dir: str) -> tuple[DataFrame, dict]:
    """(token table, totals) for a micro-batch: the newest version of the saved
    model when the batch is first seen. The version is recorded beside the
    output before anything is predicted, so a replay uses the same one."""
    record = f"{output_dir}/_models"
    if batch_id + 1 in manifest.versions(spark, record):
        version = manifest.load(spark, record, batch_id + 1)[1]["version"]
    else:
        version = model_version(spark, model_path)
        manifest.publish(spark, record, {"version": version}, batch_id)
    return load_model(spark, model_path, version)


def write_predictions(batch: DataFrame, batch_id: int, output_dir: str, model: DataFrame | str | None,
                      n_model_rows: int | None, max_length: int = 128, predictor=None, **options) -> None:
    """Predict one micro-batch into ``<output_dir>/batch_id=<n>``, replacing
    whatever an earlier attempt of the same batch wrote (idempotent replay).
    ``model``: a token table, or the path of a saved model, of which each batch
    takes the newest version (``batch_model``)."""
    if predictor is not None:
        out = predict_batch_with(batch, predictor)
    else:
        if isinstance(model, str):
            model, totals = batch_model(batch.sparkSession, model, batch_id, output_dir)
            n_model_rows = totals["n_tokens"]
        out = predict_batch(batch, model, n_model_rows, max_length, **options)
    out.write.mode("overwrite").parquet(f"{output_dir}/batch_id={batch_id}")


def request_stream(spark: SparkSession, source_dir: str | None, source_format: str = "parquet",
                   source_options: dict | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of requests ``(id, abstract)``."""
    if source_format == "kafka":
        raw = spark.readStream.format("kafka").options(**(source_options or {})).load()
        parsed = F.from_json(F.col("value").cast("string"), REQUEST_SCHEMA)
        return raw.select(parsed.alias("r")).select("r.id", "r.abstract")
    if source_format not in ("parquet", "json"):
        raise ValueError(f"Unsupported request source {source_format!r}")
    reader = spark.readStream.schema(REQUEST_SCHEMA).options(**(source_options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format(source_format).load(source_dir)


def default_checkpoint(spark: SparkSession, output_dir: str, checkpoint_dir: str | None = None) -> str:
    """The checkpoint folder that goes with an output folder, ``_checkpoint`` in it.

    An output folder that holds batches while the checkpoint is missing is
    refused: the stream would start again at batch 0 and replace them.
    """
    path = checkpoint_dir or f"{output_dir}/_checkpoint"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def found(p: str) -> bool:
        at = hadoop.Path(p)
        return bool(at.getFileSystem(conf).globStatus(at))

    if found(f"{output_dir}/batch_id=*") and not found(path):
        raise ValueError(f"{output_dir} holds predictions but {path} is missing: "
                         "name the checkpoint they were made with, or another output folder")
    return path


def start_predict_stream(spark: SparkSession, source_dir: str, model: DataFrame | str | None,
                         n_model_rows: int | None, output_dir: str, checkpoint_dir: str,
                         max_length: int = 128, available_now: bool = True,
                         max_files_per_trigger: int | None = None,
                         predictor=None, source_format: str = "parquet",
                         source_options: dict | None = None, **options) -> StreamingQuery:
    """Start the stream; ``predictor`` (optional) replaces the counted model.

    ``model``: a token table that stays, or the path of a saved model: a version
    saved while the stream runs serves the batches that start after it.
    ``options``: ``num_beams`` and ``no_repeat_ngram_size`` of the generation.

    ``source_format``: ``parquet`` or ``json`` request files in ``source_dir``
    (JSON lines ``{"id": ..., "abstract": ...}``), or ``kafka`` with
    ``source_options`` (bootstrap servers, topic) whose message values are
    such JSON objects; Kafka needs its connector on the classpath.
    """
    requests = request_stream(spark, source_dir, source_format, source_options,
                              max_files_per_trigger)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_predictions(batch, batch_id, output_dir, model, n_model_rows, max_length, predictor, **options)

    writer = (requests.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
