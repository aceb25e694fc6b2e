"""Record export (P4) over a file stream.

The original tool has no streaming.  Its record export is stateless
(flatten, clean, encode per record), so the same plan runs unchanged on a
Structured Streaming source: new JSON record files arriving in a folder are
flattened, cleaned and appended as JSON Lines; what is no record raises or is
kept apart.  No state, no watermark; the checkpoint location makes the export
exactly-once across restarts and executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.records import flatten_records


def stream_record_export(spark: SparkSession, source: str, schema: T.StructType | str, target: str,
                         checkpoint: str, document: bool = False, available_now: bool = True,
                         max_files_per_trigger: int | None = None, rejected: str | None = None) -> StreamingQuery:
    """Start a stream: JSON record files in ``source`` -> flatten + clean -> JSON Lines in ``target``.

    ``document=True`` reads each file as one JSON document (list of records
    or one record); otherwise JSON Lines.  With ``available_now`` the query
    processes what is there and stops (batch-style incremental runs).

    No record is lost: what does not parse stops the stream with an error, and
    nothing of its batch is written.  With ``rejected``, a folder, lines that do
    not parse go there instead, as they are and with their file, so one bad
    line does not stop the lines after it; both outputs then have a folder for
    each batch (``batch=<number>``, a column when read), which is replaced when
    the batch is run again after a failure.
    """
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if document and rejected:
        raise ValueError("a document is read as a whole: it has no lines to reject")
    if rejected:
        lines = reader.text(source).select("value", F.col("_metadata.file_path").alias("file"))

        def export(batch: DataFrame, number: int) -> None:
            parsed = parsed_lines(batch, schema)
            good = flatten_records(parsed.where("_bad IS NULL").select("_record.*"))
            good.write.mode("overwrite").json(f"{target}/batch={number}")
            bad = parsed.where("_bad IS NOT NULL").select(F.col("_bad").alias("line"), "file")
            bad.write.mode("overwrite").json(f"{rejected}/batch={number}")

        writer = lines.writeStream.foreachBatch(export).option("checkpointLocation", checkpoint)
    else:
        records = reader.schema(schema).option("multiLine", str(document).lower()).option("mode", "FAILFAST").json(source)
        writer = (flatten_records(records).writeStream.format("json").option("path", target)
                  .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def parsed_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows (_record, _bad, file) of JSON Lines (value, file): the record, or the line where it does not parse; blank lines are none."""
    bad = "_corrupt"
    while bad in schema.fieldNames():
        bad += "_"
    wide = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    parsed = lines.where(~F.col("value").rlike(r"^\s*$")).select(
        F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}).alias("_r"), "value", "file")
    broken = F.col("_r").isNull() | F.col("_r").getField(bad).isNotNull()
    record = F.struct(*[F.col("_r").getField(f.name).alias(f.name) for f in schema.fields])
    return parsed.select(record.alias("_record"), F.when(broken, F.col("value")).alias("_bad"), "file")
