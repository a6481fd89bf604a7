"""Queries on classification of mail attachments and library files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.functions import classify as C
from pagelake.functions import values as V
from pagelake.functions.text import email_domain
from pagelake.operators.dependent import file_system, fresh_content, qualified, sharepoint_documents
from pagelake.operators.incremental import skip_stale
from pagelake.operators.pages import FILE_ATTACHMENT, drop_page, unwrap
from pagelake.plans.pipeline import Run, run_source, table_of
from pagelake.plans.registry import query, table
from pagelake.session import scratch_dir, settle
from pagelake.sources.catalog import SOURCES
from pagelake.sources.landing import even_pages, land, store_pages


def _thread_index(turn: Column) -> Column:
    """Thread index of a turn; every fifth one is missing."""
    size = (F.lit(22) + 5 * turn).cast("int")
    text = V.encode_content(F.encode(F.repeat(F.lit("x"), size), "utf-8"))
    return F.when(F.col("conv_id") % 5 != 0, text)


def _subject() -> Column:
    return F.concat(F.repeat(F.lit("RE: "), F.col("turn").cast("int")), F.col("text"))


def _mail_name() -> Column:
    return F.when(F.col("role") == "system", F.lit("Deal_Overview.pdf")).otherwise(
        F.concat(F.lit("nda_"), F.col("turn").cast("string"), F.lit(".docx"))
    )


# The text without its white space runs, folded, as the subject is normalised.
_FOLDED = (
    "replace(lower(trim(regexp_replace(text, '[\\s\\x1c-\\x1f\\x{a0}\\x{2028}\\x{3000}]+', ' ', 'g'))),"
    " 'ß', 'ss')"
)
_DEPTH = "CASE WHEN conv_id % 5 <> 0 THEN turn ELSE 0 END"
_MAIL_ROUND = f"CASE WHEN turn > 0 THEN greatest(({_DEPTH}) + 1, 2) ELSE 1 END"
_MAIL_ROLE = (
    "CASE WHEN role = 'system' THEN 'teaser' WHEN turn > 0 THEN 'counterparty_return' "
    "ELSE 'fresh_nda' END"
)


@query(
    f"SELECT conv_id, turn, {_MAIL_ROLE} AS doc_role, {_MAIL_ROUND} AS round_no FROM conversations"
)
def classify_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as messages of a thread: the subject is the text behind one prefix per turn."""
    turns = table(spark, sf_dir, "conversations")
    found = C.classify_mail(_mail_name(), _subject(), _thread_index(F.col("turn")))
    return turns.select("conv_id", "turn", found.alias("c")).select("conv_id", "turn", "c.*")


@query(f"SELECT conv_id, turn, {_DEPTH} AS depth, turn > 0 AS is_reply FROM conversations")
def thread_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turns.select(
        "conv_id",
        "turn",
        C.conversation_depth(_thread_index(F.col("turn"))).cast("bigint").alias("depth"),
        C.subject_is_reply(_subject()).alias("is_reply"),
    )


@query(f"SELECT conv_id, turn, {_FOLDED} AS subject_normalized FROM conversations")
def normalize_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", C.normalize_subject(_subject()).alias("subject_normalized"))


@query(
    f"""
    SELECT CASE WHEN role = 'user' THEN 'c' || conv_id ELSE {_FOLDED} END AS thread, count(*) AS n
    FROM conversations GROUP BY 1
    """
)
def thread_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per thread; only the user's carry a thread id."""
    turns = table(spark, sf_dir, "conversations")
    given = F.when(F.col("role") == "user", F.concat(F.lit("c"), F.col("conv_id").cast("string")))
    keyed = turns.select(C.thread_key(given, _subject()).alias("thread"))
    return keyed.groupBy("thread").agg(F.count(F.lit(1)).alias("n"))


def _file_name() -> Column:
    """Names with round tokens from the id and role tokens from the source."""
    number = F.pmod("doc_id", F.lit(30)).cast("string")
    role = (
        F.when(F.col("source").isin("src1", "src11"), "_Teaser")
        .when(F.col("source").isin("src2", "src12"), "_REDLINED")
        .when(F.col("source").isin("src3", "src13"), "_encounter")
        .otherwise("")
    )
    version = (
        F.when(F.col("lang") == "en", F.concat(F.lit("_v"), number))
        .when(F.col("lang") == "de", F.concat(F.lit(" round "), number, F.lit("_draft1")))
        .when(F.col("lang") == "fr", F.concat(F.lit("_v2024-rev"), number))
        .otherwise("")
    )
    return F.concat(F.lit("nda"), role, version, F.lit(".docx"))


_NUMBER = """
    CASE WHEN lang IN ('en', 'fr') THEN doc_id % 30
         WHEN lang = 'de' THEN greatest(doc_id % 30, 1) END
"""
_FILE_ROLE = """
    CASE WHEN source IN ('src1', 'src11') THEN 'teaser'
         WHEN source IN ('src2', 'src12', 'src3', 'src13') THEN 'counterparty_return'
         ELSE 'fresh_nda' END
"""
_FILE_ROUND = f"""
    coalesce(nullif({_NUMBER}, 0),
             CASE WHEN source IN ('src2', 'src12', 'src3', 'src13') THEN 2 ELSE 1 END)
"""


@query(f"SELECT doc_id, {_FILE_ROLE} AS doc_role, {_FILE_ROUND} AS round_no FROM documents")
def classify_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", C.classify_file(_file_name()).alias("c")).select("doc_id", "c.*")


@query(f"SELECT doc_id, {_NUMBER} AS round_no FROM documents")
def round_from_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", C.round_from_filename(_file_name()).cast("bigint").alias("round_no")
    )


@query(
    """
    SELECT doc_id,
           regexp_matches(lower(text), 'teaser|cim|one-pager|onepager|flyer|overview') AS teaser,
           regexp_matches(lower(text),
             'return|redline|markup|marked-up|counter|revised|comments|tracked') AS returned
    FROM documents
    """
)
def has_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens anywhere in the whole texts."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        C.has_token(F.col("text"), C.TEASER_TOKENS).alias("teaser"),
        C.has_token(F.col("text"), C.RETURN_TOKENS).alias("returned"),
    )


@query(
    """
    SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS domain FROM pages
    """
)
def sender_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts of pages as upper case sender domains."""
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)
    address = F.concat(F.lit("first.last@relay@"), F.upper(host))
    return table(spark, sf_dir, "pages").select("page_id", email_domain(address).alias("domain"))


def document_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Turns as messages with one attachment each, documents as library files with bytes."""
    turns = table(spark, sf_dir, "conversations").withColumn(
        "id", F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    )
    value = lambda items: F.struct(items.alias("value"))
    sent = F.date_format(
        F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.col("conv_id").cast("int")),
        "yyyy-MM-dd'T'HH:mm:ss'Z'",
    )
    address = F.concat("role", F.lit("@Conv"), F.col("conv_id").cast("string"), F.lit(".Example"))
    messages = land(
        turns,
        record=F.struct(
            "id",
            _subject().alias("subject"),
            sent.alias("receivedDateTime"),
            F.col("conv_id").cast("string").alias("conversationId"),
            _thread_index(F.col("turn")).alias("conversationIndex"),
            F.lit(True).alias("hasAttachments"),
            F.struct(F.struct(address.alias("address")).alias("emailAddress")).alias("from"),
        ),
        # Newest first: the position falls with the conversation number.
        order=F.struct(-F.col("conv_id"), "turn"),
        page_no=F.lit(1 << 40) - F.floor(F.col("conv_id") / 10),
        envelope=value,
        source="m365_graph",
        resource="messages",
    )
    attachments = land(
        turns,
        record=F.struct(
            F.lit(FILE_ATTACHMENT).alias("@odata.type"),
            F.lit("a1").alias("id"),
            _mail_name().alias("name"),
            F.octet_length(F.encode("text", "utf-8")).alias("size"),
            V.encode_content(F.encode("text", "utf-8")).alias("contentBytes"),
        ),
        order=F.col("id"),
        feed=F.col("id"),
        page_no=F.lit(1),
        envelope=value,
        source="m365_graph",
        resource="attachments",
    ).withColumn("request_key", F.create_map(F.lit("message_id"), F.col("feed")))
    docs = table(spark, sf_dir, "documents")
    modified = F.concat(F.lit("2024-02-"), F.lpad((1 + F.pmod("doc_id", F.lit(28))).cast("string"), 2, "0"), F.lit("T00:00:00Z"))
    items = land(
        docs,
        record=F.struct(
            F.col("doc_id").cast("string").alias("id"),
            _file_name().alias("name"),
            modified.alias("lastModifiedDateTime"),
            F.struct(F.lit("application/pdf").alias("mimeType")).alias("file"),
            F.struct(
                F.struct(F.concat("lang", F.lit("@Docs.Example")).alias("email")).alias("user")
            ).alias("createdBy"),
        ),
        order=F.col("doc_id"),
        page_no=even_pages(docs, ["doc_id"], 200),
        envelope=value,
        source="m365_graph",
        resource="drive_children",
    )
    content = docs.select(
        F.col("doc_id").cast("string").alias("item_id"), F.encode("text", "utf-8").alias("content")
    )
    pages = messages.unionByName(attachments).unionByName(items)
    return store_pages(pages, scratch_dir(spark, "landing")), content


@query(
    f"""
    SELECT 'outlook:' || conv_id || '-' || turn || ':a1' AS document_id, {_MAIL_ROLE} AS doc_role,
           {_MAIL_ROUND} AS round_no, 'conv' || conv_id || '.example' AS counterparty,
           CASE WHEN role = 'system' THEN 'Deal_Overview.pdf' ELSE 'nda_' || turn || '.docx' END
             AS filename,
           {_FOLDED} AS subject_normalized, base64(encode(text)) AS content_base64,
           TIMESTAMP '2024-01-01' + to_days(CAST(conv_id AS INTEGER)) AS received_at,
           CAST(NULL AS TIMESTAMP) AS modified_at
    FROM conversations
    UNION ALL
    SELECT 'sharepoint:site:' || doc_id, {_FILE_ROLE}, {_FILE_ROUND}, lang || '@Docs.Example',
           'nda' || CASE WHEN source IN ('src1', 'src11') THEN '_Teaser'
                         WHEN source IN ('src2', 'src12') THEN '_REDLINED'
                         WHEN source IN ('src3', 'src13') THEN '_encounter' ELSE '' END
                 || CASE lang WHEN 'en' THEN '_v' || (doc_id % 30)
                              WHEN 'de' THEN ' round ' || (doc_id % 30) || '_draft1'
                              WHEN 'fr' THEN '_v2024-rev' || (doc_id % 30) ELSE '' END || '.docx',
           NULL, base64(encode(text)), NULL,
           TIMESTAMP '2024-02-01' + to_days(CAST(doc_id % 28 AS INTEGER))
    FROM documents
    """
)
def documents_union_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both planes loaded into the one documents table, merged by document id, twice."""
    pages, content = document_pages(spark, sf_dir)
    warehouse = scratch_dir(spark, "dropzone")
    options = {"mailbox": "in@our.example", "site_id": "site", "content": content}
    for _ in range(2):
        run_source(spark, SOURCES["m365_graph"], pages, warehouse, **options)
    rows = table_of(spark, warehouse, "m365_graph", "documents").read()
    return rows.select(
        "document_id",
        "doc_role",
        "round_no",
        "counterparty",
        "filename",
        "subject_normalized",
        "content_base64",
        F.col("received_at").cast("timestamp_ntz").alias("received_at"),
        F.col("modified_at").cast("timestamp_ntz").alias("modified_at"),
    )


@query(
    f"""
    SELECT 'outlook:' || conv_id || '-' || turn || ':a1' AS document_id, {_MAIL_ROLE} AS doc_role
    FROM conversations WHERE conv_id > 20
    """
)
def mail_documents_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attachments of the messages received after the mark."""
    pages, _ = document_pages(spark, sf_dir)
    run = Run(
        spark,
        SOURCES["m365_graph"],
        pages,
        {"mail_documents": "2024-01-21T00:00:00Z"},
        mailbox="in@our.example",
    )
    return run.rows("mail_documents").select("document_id", "doc_role")


def _write_library(docs: DataFrame, folder: str) -> None:
    """One text file for each ``item``, its ``value`` and a line feed; values of one item in one task share a file.

    A task has folders of its own, each of at most 1,000 files, so no step over all files is left to the driver and a
    repeated task writes the same files again.
    """
    root = qualified(docs.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = file_system(root)
        task, files, item, out = TaskContext.get().partitionId(), 0, None, None
        for batch in batches:
            for name, value in zip(batch.column("item").to_pylist(), batch.column("value").to_pylist(), strict=True):
                if out is None or name != item:
                    if out is not None:
                        out.close()
                    at = f"{top}/part-{task}-{files // 1000}"
                    if files % 1000 == 0:
                        fs.create_dir(at, recursive=True)
                    item, out, files = name, fs.open_output_stream(f"{at}/{name}.txt"), files + 1
                out.write(value.encode() + b"\n")
        if out is not None:
            out.close()
        yield pa.record_batch([pa.array([files], pa.int64())], ["files"])

    docs.sortWithinPartitions("item").mapInArrow(write, "files bigint").agg(F.sum("files")).collect()


ITEM = (
    "id string, name string, size bigint, file struct<mimeType:string>, webUrl string, lastModifiedDateTime string, "
    "createdBy struct<user:struct<email:string>>"
)


@query(
    """
    SELECT 'sharepoint:site:' || doc_id AS document_id, strlen(coalesce(text, '')) + 1 AS size_bytes,
      sha256(to_base64(encode(coalesce(text, '') || chr(10)))) AS content_sha256
    FROM documents WHERE doc_id % 3 <> 0
    """
)
def library_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as files of a library: those of fresh items are read, the others only listed."""
    docs = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    folder = scratch_dir(spark, "library")
    _write_library(docs.select(F.col("doc_id").cast("string").alias("item"), F.col("text").alias("value")), folder)
    record = F.struct(
        F.col("doc_id").cast("string").alias("id"),
        F.concat("lang", F.lit(".txt")).alias("name"),
        (F.octet_length("text") + 1).alias("size"),
        F.struct(F.lit("text/plain").alias("mimeType")).alias("file"),
        F.when(F.col("doc_id") % 3 != 0, "2024-02-01T00:00:00Z").otherwise("2023-02-01T00:00:00Z").alias("lastModifiedDateTime"),
    )
    items = land(docs, record=record, order=F.col("doc_id"), page_no=F.floor(F.col("doc_id") / 200) + 1, envelope=lambda x: F.struct(x.alias("value")), source="m365_graph", resource="items")
    fresh = settle(skip_stale(drop_page(unwrap(items, "value", ITEM)), "lastModifiedDateTime", "2024-01-01T00:00:00Z"))
    of_file = F.regexp_extract("path", "/([^/]*)[.]txt$", 1)
    found = sharepoint_documents(fresh, fresh_content(spark, folder, fresh, item_of=of_file), "site")
    return found.select("document_id", "size_bytes", F.sha2("content_base64", 256).alias("content_sha256"))
