"""Table metadata documents on storage: which one is current, and what it says, for many table folders at once.

A table folder holds ``metadata/`` with one JSON document per version and, often, ``version-hint.text``. Folders are
dealt out evenly, some hundred to a task; a task reads the hint, else lists the documents, and returns the text of the
current one. What cannot be read becomes a row with an error, so one bad table does not end a run.
"""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.operators.table_metadata import table_facts

#: Folders that one task visits; a visit is a few requests to the store.
FOLDERS_PER_TASK = 200
# Where the documents lie and how they are named.
FOLDER, HINT, DOCUMENT = "metadata", "version-hint.text", ".metadata.json"


def _split(location: str):
    """File system and path of a location; the schemes of Spark's S3 connectors are those of one store."""
    from pyarrow import fs

    if location.startswith("file:"):
        location = re.sub(r"^file:/*", "/", location)
    if "://" not in location:
        return fs.LocalFileSystem(), location
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", location))


def version_of(name: str) -> int:
    """Leading number of a document's name, -1 without one."""
    found = re.match(r"v?([0-9]+)", name)
    return int(found.group(1)) if found else -1


def current_document(location: str) -> tuple[str, str]:
    """Name and text of the current document of one table: the hinted version, else the highest number."""
    from pyarrow import fs

    store, path = _split(location.rstrip("/"))
    folder = f"{path}/{FOLDER}"

    def read(name: str) -> str:
        with store.open_input_stream(f"{folder}/{name}") as stream:
            return stream.read().decode("utf-8")

    if store.get_file_info(folder).type != fs.FileType.Directory:
        raise FileNotFoundError("no metadata folder")
    if store.get_file_info(f"{folder}/{HINT}").type == fs.FileType.File:
        lines = read(HINT).splitlines()
        name = f"v{lines[0].strip() if lines else ''}{DOCUMENT}"
        if store.get_file_info(f"{folder}/{name}").type != fs.FileType.File:
            raise FileNotFoundError(f"hinted document does not exist: {name}")
    else:
        names = [i.base_name for i in store.get_file_info(fs.FileSelector(folder)) if i.base_name.endswith(DOCUMENT)]
        if not names:
            raise FileNotFoundError("no metadata document")
        name = max(names, key=lambda n: (version_of(n), n))
    return name, read(name)


def read_documents(tables: DataFrame, path: str = "table_path") -> DataFrame:
    """``tables`` with metadata_file, metadata (its text) and error of each table's current document.

    Equal folders are visited once per row. A null path gets an error. Reading is lazy and repeated if the result is
    used twice, as any Spark source's.
    """
    names = [c for c in tables.columns if c not in ("metadata_file", "metadata", "error")]
    tables = tables.select(*names)
    schema = tables.schema.add("metadata_file", "string").add("metadata", "string").add("error", "string")

    def visit(batches):
        for b in batches:
            found = []
            for location in b[path].to_pylist():
                try:
                    if location is None:
                        raise FileNotFoundError("no path")
                    found.append((*current_document(location), None))
                except (OSError, ValueError) as e:  # what stores raise; a fault of the code itself still ends the job
                    found.append((None, None, str(e).splitlines()[0] if str(e) else type(e).__name__))
            columns = [pa.array([f[i] for f in found], pa.string()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], [*names, "metadata_file", "metadata", "error"])

    tasks = max(1, -(-tables.count() // FOLDERS_PER_TASK))
    return tables.repartition(tasks).mapInArrow(visit, schema)


def read_table_facts(tables: DataFrame, path: str = "table_path") -> DataFrame:
    """``tables`` with metadata_file, error, and the facts of :func:`table_facts`; a document that is no JSON object is an error."""
    read = read_documents(tables, path)
    broken = F.col("error").isNull() & (F.coalesce(F.schema_of_variant(F.try_parse_json("metadata")), F.lit("")).startswith("OBJECT") == F.lit(False))
    read = read.withColumn("error", F.when(broken, F.concat(F.lit("not a JSON document: "), F.col("metadata_file"))).otherwise(F.col("error")))
    return table_facts(read.withColumn("metadata", F.when(F.col("error").isNull(), F.col("metadata"))))


def put_texts(files: DataFrame, root: str | None = None, path: str = "path", content: str = "content") -> int:
    """Write one text file per row, whole or not at all, at ``path`` (below ``root`` if given); returns how many."""

    def put(batches):
        for b in batches:
            for place, text in zip(b[path].to_pylist(), b[content].to_pylist()):
                store, target = _split(f"{root.rstrip('/')}/{place}" if root else place)
                folder, _, name = target.rpartition("/")
                store.create_dir(folder, recursive=True)
                temporary = f"{folder}/.{name}.{uuid.uuid4().hex}"
                with store.open_output_stream(temporary) as stream:
                    stream.write((text or "").encode("utf-8"))
                store.move(temporary, target)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    return files.select(path, content).mapInArrow(put, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_documents(files: DataFrame, path: str = "table_path", name: str = "file_name", content: str = "content") -> int:
    """Write text files below the ``metadata`` folders of tables; returns how many."""
    place = F.concat(F.rtrim(path, F.lit("/")), F.lit(f"/{FOLDER}/"), F.col(name))
    return put_texts(files.select(place.alias("path"), F.col(content).alias("content")))
