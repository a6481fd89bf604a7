"""Children of a parent increment: landed child pages joined with their parents."""

from __future__ import annotations

from collections.abc import Collection, Iterator, Mapping

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.functions import classify as C
from pagelake.functions import values as V
from pagelake.functions.jsonpath import as_type
from pagelake.functions.text import email_domain
from pagelake.operators.contract import columns, ensure_columns
from pagelake.operators.joins import HOT_PAGES, lookup_join
from pagelake.operators.pages import file_attachments, file_items, unwrap, with_attachments
from pagelake.session import settle


def child_pages(
    parents: DataFrame, pages: DataFrame, link: Mapping[str, str | Column], **stamped: str | Column
) -> DataFrame:
    """Pages fetched for parents of this increment.

    ``link`` maps an entry of ``request_key`` to the parent's column; ``stamped`` adds
    parent columns under new names. Pages are the large side; a parent contributes one
    narrow row, and several rows of one parent count once.
    """
    keys = {f"_key_{k}": _col(v).cast("string") for k, v in link.items()}
    wanted = parents.select(
        *[v.alias(k) for k, v in keys.items()], *[_col(v).alias(k) for k, v in stamped.items()]
    ).dropDuplicates(list(keys))
    keyed = pages.withColumns(
        {f"_key_{k}": F.try_element_at("request_key", F.lit(k)) for k in link}
    )
    joined = lookup_join(
        keyed, wanted, list(keys), "inner", spread=["feed", "page_no"], hot_rows=HOT_PAGES
    )
    return joined.drop(*keys)


def children(
    parents: DataFrame,
    pages: DataFrame,
    link: Mapping[str, str | Column],
    selector: str,
    record: T.DataType | str,
    **stamped: str | Column,
) -> DataFrame:
    """Records of the child pages of this increment, parent columns stamped on."""
    found = child_pages(parents, pages, link, **stamped)
    return unwrap(found, selector, record, carry=list(stamped))


def children_of_increment(children_df: DataFrame, parents: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Child rows whose parent is in the increment (``{child column: parent column}``)."""
    wanted = parents.select(*[F.col(p).alias(c) for c, p in on.items()]).distinct()
    return lookup_join(children_df, wanted, list(on), "left_semi")


def skipped_parents(
    parents: DataFrame, pages: DataFrame, link: Mapping[str, str | Column], skip: Collection[int]
) -> DataFrame:
    """Parents whose child feed ended on a skipped status, on its first page or a later one."""
    ended = pages.where(F.col("http_status").isin(*skip)).select(
        *[F.try_element_at("request_key", F.lit(k)).alias(f"_key_{k}") for k in link]
    )
    keyed = parents.withColumns({f"_key_{k}": _col(v).cast("string") for k, v in link.items()})
    names = [f"_key_{k}" for k in link]
    return lookup_join(keyed, ended.distinct(), names, "left_semi").drop(*names)


def invoice_line_items(invoices: DataFrame, overflow: DataFrame, line: T.DataType | str) -> DataFrame:
    """Line items of the invoices: the embedded ones, then those on overflow pages.

    Overflow pages count only for invoices that say ``has_more`` and embed at least one
    line with an id to continue after.
    """
    line = as_type(line)
    fields = [F.col(f"_line.`{f.name}`") for f in line.fields if f.name != "invoice_id"]
    embedded = invoices.select(
        F.col("id").alias("invoice_id"), F.explode("lines.data").alias("_line")
    ).select("invoice_id", *fields)
    last = F.get(F.col("lines.data"), F.size("lines.data") - 1)["id"]
    open_ended = invoices.where(F.col("lines.has_more") & last.isNotNull())
    rest = children(open_ended, overflow, {"invoice_id": "id"}, "data", line, invoice_id="id")
    return embedded.unionByName(rest.select(*embedded.columns))


def unnest(parents: DataFrame, column: str, parent_key: str, name: str) -> DataFrame:
    """One row per element of an array of structs, with the parent's key as ``name``."""
    rows = parents.select(F.col(parent_key).alias(name), F.explode(column).alias("_element"))
    inner = [f.name for f in rows.schema["_element"].dataType.fields if f.name != name]
    return rows.select(*[f"_element.`{f}`" for f in inner], name)


def deal_stage_join(deals: DataFrame, stages: DataFrame) -> DataFrame:
    """Deals with the name, pipeline and probability of their stage."""
    named = stages.select(
        "pipeline_id",
        F.col("id").alias("stage_id"),
        F.col("name").alias("stage_name"),
        "pipeline_name",
        "deal_probability",
    )
    return lookup_join(deals, named, ["pipeline_id", "stage_id"], "left")


# Columns of the shared documents table, in order.
DOCUMENT_TYPES = columns(
    text=[
        "document_id",
        "source_system",
        "mailbox",
        "site_id",
        "message_id",
        "attachment_id",
        "item_id",
        "conversation_id",
        "subject",
        "subject_normalized",
        "doc_role",
        "counterparty",
        "sender_address",
        "filename",
        "content_type",
        "web_url",
        "content_base64",
    ],
    bigint=["round_no", "size_bytes"],
    timestamp=["received_at", "modified_at"],
)

ATTACHMENT = (
    "`@odata.type` string, id string, name string, contentType string, size bigint, "
    "isInline boolean, contentBytes string"
)


def mail_documents(messages: DataFrame, attachment_pages: DataFrame, mailbox: str) -> DataFrame:
    """File attachments of the fresh messages, classified by thread position."""
    sender = F.col("from.emailAddress.address")
    found = children(
        with_attachments(messages),
        attachment_pages,
        {"message_id": "id"},
        "value",
        ATTACHMENT,
        message_id="id",
        conversation_id="conversationId",
        conversation_index="conversationIndex",
        subject="subject",
        sender_address=sender,
        web_url="webLink",
        received_at="receivedDateTime",
    )
    files = file_attachments(found)
    filename = V.name_or(F.col("name"), "attachment")
    rows = files.select(
        V.joined_key("outlook", F.col("message_id"), F.col("id")).alias("document_id"),
        F.lit("outlook").alias("source_system"),
        F.lit(mailbox).alias("mailbox"),
        "message_id",
        F.col("id").alias("attachment_id"),
        "conversation_id",
        "subject",
        C.normalize_subject(F.col("subject")).alias("subject_normalized"),
        C.classify_mail(filename, F.col("subject"), F.col("conversation_index")).alias("_class"),
        email_domain(F.col("sender_address")).alias("counterparty"),
        "sender_address",
        filename.alias("filename"),
        F.col("contentType").alias("content_type"),
        F.col("size").alias("size_bytes"),
        "web_url",
        F.col("contentBytes").alias("content_base64"),
        "received_at",
    )
    return _documents(rows.select("*", "_class.*"), "received_at")


def sharepoint_documents(items: DataFrame, content: DataFrame, site_id: str) -> DataFrame:
    """Fresh library files with their bytes (``item_id``, ``content``), classified by name.

    A file without bytes fails the job.
    """
    files = file_items(items)
    filename = V.name_or(F.col("name"), "file")
    email = F.col("createdBy.user.email")
    described = files.select(
        F.col("id").alias("item_id"),
        V.joined_key("sharepoint", F.lit(site_id), F.col("id")).alias("document_id"),
        F.lit("sharepoint").alias("source_system"),
        F.lit(site_id).alias("site_id"),
        C.classify_file(filename).alias("_class"),
        email.alias("counterparty"),
        email.alias("sender_address"),
        filename.alias("filename"),
        F.col("file.mimeType").alias("content_type"),
        F.col("size").alias("size_bytes"),
        F.col("webUrl").alias("web_url"),
        F.col("lastModifiedDateTime").alias("modified_at"),
    ).select("*", "_class.*")
    described = described.drop("_class")
    found = lookup_join(content, described, ["item_id"], "inner")
    found = found.withColumn("content_base64", V.encode_content(F.col("content")))
    lost = F.concat(F.lit("no content for item "), F.col("item_id"))
    missing = described.join(content.select("item_id"), "item_id", "left_anti").withColumn(
        "content_base64", F.raise_error(lost).cast("string")
    )
    return _documents(found.drop("content").unionByName(missing), "modified_at")


def _documents(rows: DataFrame, cursor: str) -> DataFrame:
    """Rows in the shape of the documents table, with the cursor as it came in ``_cursor``."""
    marked = rows.withColumn("_cursor", F.col(cursor))
    aligned = ensure_columns(marked, DOCUMENT_TYPES)
    return aligned.select(*DOCUMENT_TYPES, "_cursor")


#: Files and bytes that one task lists or reads.
PACK_FILES, PACK_BYTES = 2_000, 128 << 20

_FILE_ROW = "path string, length bigint, modificationTime timestamp"


def qualified(spark, path: str) -> str:
    """The path with its file system, as the cluster resolves it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a qualified path, for use in a task, and the path on it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


def _visible(below: str) -> bool:
    """Whether Spark would list a file of this path below the folder."""
    return not any(p.startswith(".") or (p.startswith("_") and "=" not in p) or p.endswith("._COPYING_") for p in below.split("/"))


def _listing(root: str, recursive: bool):
    """Lists folders below ``root``; a folder inside, if not entered, is a row without a length."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = file_system(root)
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                found = fs.get_file_info(pafs.FileSelector(top + folder.removeprefix(root), recursive=recursive))
                below = [f.path[len(top) :] for f in found]
                rows = [(f, b) for f, b in zip(found, below, strict=True) if _visible(b.strip("/")) and (f.is_file or not recursive)]
                yield pa.record_batch(
                    [
                        pa.array([root + b for _, b in rows], pa.string()),
                        pa.array([f.size if f.is_file else None for f, _ in rows], pa.int64()),
                        pa.array([f.mtime for f, _ in rows], pa.timestamp("us", "UTC")),
                    ],
                    ["path", "length", "modificationTime"],
                )

    return listed


def file_list(spark, path: str) -> DataFrame:
    """path, length and modificationTime of the files below ``path`` that hold bytes; no file is opened.

    A task lists ``path`` itself, then tasks list the folders in it, each with all below it.
    """
    root = qualified(spark, path).rstrip("/")
    top = settle(spark.createDataFrame([(root,)], "path string").mapInArrow(_listing(root, False), _FILE_ROW))
    folders = top.where("length is null").select("path")
    tasks = max(1, min(folders.count(), 4 * spark.sparkContext.defaultParallelism))
    deep = folders.repartition(tasks).mapInArrow(_listing(root, True), _FILE_ROW)
    return top.where("length is not null").unionByName(deep).where("length > 0")


def file_name() -> Column:
    """The last part of a file's path."""
    return F.element_at(F.split("path", "/"), -1)


def _reading(root: str, most: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = file_system(root)
        for batch in batches:
            items, contents, held = [], [], 0
            for path, item, length in zip(*(batch.column(c).to_pylist() for c in ("path", "item_id", "length")), strict=True):
                if length > most:
                    raise ValueError(f"{path} has {length} bytes, more than spark.sql.sources.binaryFile.maxLength")
                # What is held goes out first, so that a batch holds 16 MB or one file.
                if held + length > 16 << 20 and items:
                    yield pa.record_batch([pa.array(items, pa.string()), pa.array(contents, pa.binary())], ["item_id", "content"])
                    items, contents, held = [], [], 0
                with fs.open_input_stream(top + path.removeprefix(root)) as file:
                    contents.append(file.read())
                items.append(item)
                held += length
            yield pa.record_batch([pa.array(items, pa.string()), pa.array(contents, pa.binary())], ["item_id", "content"])

    return read


def fresh_content(
    spark, path: str, items: DataFrame, *, item_of: Column | None = None, pack_files: int = PACK_FILES, pack_bytes: int = PACK_BYTES
) -> DataFrame:
    """item_id, content of the files below ``path`` that belong to ``items`` (their ``id``).

    Paths and lengths are listed first and joined with the items; only the files that remain are opened, each once,
    by tasks of about ``pack_files`` files and ``pack_bytes`` bytes, and what they hold is settled. No path passes through
    the driver. ``item_of`` tells the item of a path (default: the file name). Empty files are not listed: items whose
    ``size`` is 0 get empty content. The file system must be one that Arrow opens (local, HDFS, S3, GCS, Azure).
    """
    named = file_list(spark, path).withColumn("item_id", file_name() if item_of is None else item_of)
    ids = items.select(F.col("id").cast("string").alias("item_id")).distinct()
    chosen = settle(lookup_join(named, ids, ["item_id"], "left_semi"))
    size = chosen.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    packs = max(1, min(size["n"], spark.sparkContext.defaultParallelism), -(-size["n"] // pack_files), -(-size["bytes"] // pack_bytes))
    most = spark.conf.get("spark.sql.sources.binaryFile.maxLength", str((1 << 31) - 1))
    reading = _reading(qualified(spark, path).rstrip("/"), int(most))
    dealt = chosen.select("path", "item_id", "length").repartition(packs, "path")
    found = settle(dealt.mapInArrow(reading, "item_id string, content binary"))
    if "size" not in items.columns:
        return found
    empty = items.where("size = 0").select(F.col("id").cast("string").alias("item_id")).distinct()
    return found.unionByName(empty.withColumn("content", F.lit("").cast("binary")))


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
