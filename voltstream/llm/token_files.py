"""Token-ID / binary output: flat unsigned-integer files plus 64-bit document offsets.

Layout of an output folder: per shard (one Spark partition of a total order)

* ``<shard>.ids``      little-endian token ids, document after document; uint16 if the vocabulary and the
  end id fit, else uint32 (``id_type`` in the manifest)
* ``<shard>.docs``     little-endian int64 document ids
* ``<shard>.counts``   little-endian int64, ids of each document
* ``<shard>-<attempt>.offsets``  little-endian int64, one more than documents: document i of the shard owns
  the global token positions offsets[i] .. offsets[i + 1] - 1; minus offsets[0] they index ``<shard>.ids``

and a manifest table: shard, name, id_type, n_docs, n_ids, base, offsets (that file's name). ``base``, the ids of all earlier
shards, is a prefix sum over the manifest's counts, one row per partition. Files carry a name unique
to the task attempt and only attempts that Spark committed reach the manifest, so a rerun after a lost
executor leaves at worst unlisted files. Folders are reached through ``pyarrow.fs`` (local or shared
mounts, HDFS, S3, GCS); on a mount the files are memory-mapped.

Cases: a very long text is encoded whole, a slice of its own; a NULL or empty text is a document of the end id alone; NULL document ids sort first and are
stored as the smallest int64 (read back as NULL); repeated ids stay separate documents, ordered by the
further ``order`` columns, then by a hash of the text and the text; an empty table gives an empty manifest and no files; other
columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltstream.llm.common import filled, small_batches, stage, text_slices
from voltstream.llm.encode import WordEncoder, default_path
from voltstream.session import run_dir

_NULL_ID = np.iinfo(np.int64).min
#: Ids checked and given back at once when files are read.
READ_IDS = 1 << 22


def _folder(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _mapped(uri: str, name: str, dtype: str) -> np.ndarray:
    """A file's numbers: memory-mapped on a mounted file system, read elsewhere."""
    from pyarrow import fs

    system, path = _folder(uri)
    if system.get_file_info(f"{path}/{name}").size == 0:
        return np.empty(0, dtype)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(f"{path}/{name}", dtype=dtype, mode="r")
    with system.open_input_file(f"{path}/{name}") as f:
        return np.frombuffer(f.read(), dtype=dtype)


def write_token_files(spark: SparkSession, docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                      order: list | None = None, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Encode whole texts and write them in ``order`` (columns; the id by default). Returns the manifest."""
    tokenizer = tokenizer or default_path()
    order = order or [F.col(id_col)]
    keys = {f"o{i}": c for i, c in enumerate(order)}
    rows = docs.select(*[c.alias(k) for k, c in keys.items()], F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ties = [*keys, F.xxhash64("text")]  # so that even one repeated id can spread over shards
    rows = rows.repartitionByRange(*ties).sortWithinPartitions(*ties, "text").select("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        name = f"{shard:06d}-{uuid.uuid4().hex}"
        system, path = _folder(folder)
        system.create_dir(path, recursive=True)
        encoder, n_docs, n_ids, out = WordEncoder(tokenizer), 0, 0, []
        id_type = "<u2" if max(encoder.size - 1, end_id) < 1 << 16 else "<u4"
        for part in text_slices(batches, "text"):
            if not out:
                out = [system.open_output_stream(f"{path}/{name}.{kind}") for kind in ("ids", "docs", "counts")]
            ids, counts = encoder.ids(filled(part, "text"), end_id)
            doc = part.column("id").fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
            for f, x in zip(out, (ids.astype(id_type, copy=False), doc.astype("<i8", copy=False), counts.astype("<i8", copy=False))):
                f.write(np.ascontiguousarray(x))
            n_docs, n_ids = n_docs + len(counts), n_ids + len(ids)
        for f in out:
            f.close()
        if out:
            yield pa.RecordBatch.from_pydict({"shard": [shard], "name": [name], "id_type": [id_type], "n_docs": [n_docs], "n_ids": [n_ids]})

    with small_batches(spark, 2500):
        written = stage(spark, rows.mapInArrow(write, "shard long, name string, id_type string, n_docs long, n_ids long"), "token-shards")
    # one row per partition: small whatever the corpus
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = written.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _folder(folder)
        for batch in batches:
            names = []
            for row in batch.to_pylist():
                counts = _mapped(folder, f"{row['name']}.counts", "<i8")
                at = np.concatenate([[0], np.cumsum(counts)]) + row["base"]
                names.append(f"{row['name']}-{uuid.uuid4().hex}.offsets")
                with system.open_output_stream(f"{path}/{names[-1]}") as f:
                    f.write(at.astype("<i8").tobytes())
            yield batch.append_column("offsets", pa.array(names))

    return stage(spark, based.mapInArrow(offsets, "shard long, name string, id_type string, n_docs long, n_ids long, base long, offsets string"), "manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens, ids_crc32 (of the little-endian uint32 ids), one task per shard at most."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files = (f"{row['name']}.ids", row["id_type"]), (f"{row['name']}.docs", "<i8"), (row["offsets"], "<i8")
                ids, doc, at = (_mapped(folder, name, dtype) for name, dtype in files)
                start, end = at[:-1] - at[0], at[1:] - at[0]
                step = np.flatnonzero(np.diff(end // READ_IDS)) + 1
                for a, b in zip([0, *step], [*step, len(doc)]):
                    crc = [zlib.crc32(ids[x:y].astype("<u4").tobytes()) for x, y in zip(start[a:b], end[a:b])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc[a:b], mask=doc[a:b] == _NULL_ID), pa.array(at[a:b]), pa.array(at[a + 1:b + 1] - at[a:b]), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.repartition(max(1, manifest.count())).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, encoded, written and read back."""
    return encode_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


def encode_documents(spark: SparkSession, docs: DataFrame, order: list | None = None) -> DataFrame:
    folder = run_dir(spark, "token-files")
    return read_token_files(write_token_files(spark, docs, folder, order=order), folder)
