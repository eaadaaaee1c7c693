"""One query per operator, over whole tables. Each takes (spark, folder)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.functions import text
from pagequarry.functions.text import decode_text
from pagequarry.operators import (
    answer,
    changes,
    chat,
    chunk,
    diverse,
    ids,
    index,
    nearest,
    parse,
    pdf,
    quantise,
    stored,
)
from pagequarry.operators.concat import ordered_concat
from pagequarry.operators.embed import embed, hashed_words
from pagequarry.operators.explode import explode_once
from pagequarry.plans.pdf_files import write_pdf
from pagequarry.scratch import materialise, scratch_path
from pagequarry.session import ship_package, spread
from pagequarry.sources import files, tables
from pagequarry.sources import snapshots as kept
from pagequarry.streaming import ingest, respond

Query = Callable[[SparkSession, str], DataFrame]

EMBEDDER = hashed_words(64)
GENERATOR = answer.extractive()
QUERIES: dict[str, Query] = {}
# Most documents or pages that a task parses or cuts: its time does not grow with the table.
ROWS_PER_TASK = 2000


def query(run: Query) -> Query:
    def shipped(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return run(spark, folder)

    QUERIES[run.__name__] = shipped
    return run


# -- inputs ------------------------------------------------------------------------


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(
    spark: SparkSession, folder: str, rows_per_task: int | None = ROWS_PER_TASK
) -> DataFrame:
    """Extracted texts, dealt out to all cores before the costly steps."""
    rows = table(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    return spread(rows, rows_per_task)


def raw_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Web pages as binary documents."""
    pages = spread(table(spark, folder, "pages"), ROWS_PER_TASK)
    return pages.select(
        "page_id", F.col("url").alias("path"), F.encode("html", "UTF-8").alias("content")
    )


def page_elements(spark: SparkSession, folder: str) -> DataFrame:
    elements = parse.parse_html(raw_pages(spark, folder), "page_id")
    return elements.withColumn("tag", F.col("metadata")["tag"]).drop("metadata")


def page_texts_of(spark: SparkSession, folder: str) -> DataFrame:
    elements = parse.html_elements(decode_text(F.col("content")))
    return parse.texts_by_page(raw_pages(spark, folder), elements, "page_id")


def page_text_chunks(content: Column) -> Column:
    return chunk.stride_chunks(parse.html_text(content))


def chunk_table(spark: SparkSession, folder: str) -> DataFrame:
    """The chunk table of all pages, written once: (id, url, content, page, embedding)."""
    pieces = chunk.explode_chunks(
        raw_pages(spark, folder), page_text_chunks(F.col("content")), "page_id", "path"
    )
    rows = pieces.select(
        ids.hash_id(F.col("page_id"), F.col("chunk_ix")).alias("id"),
        F.col("path").alias("url"),
        "content",
        F.col("page_id").alias("page"),
        embed(F.col("content"), EMBEDDER).alias("embedding"),
    )
    return materialise(rows, "chunks")


def questions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("qid"), F.col("text").alias("question")
    )


def all_hits(spark: SparkSession, folder: str, k: int = 4) -> DataFrame:
    asked = answer.embed_questions(questions(spark, folder), EMBEDDER)
    return nearest.retrieve(asked, chunk_table(spark, folder), k)


def all_answers(spark: SparkSession, folder: str, parallel: int | None = None) -> DataFrame:
    return answer.answer_questions(
        questions(spark, folder),
        chunk_table(spark, folder),
        EMBEDDER,
        GENERATOR,
        parallel=parallel,
    )


def vectors(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All vectors as questions, and as a corpus whose lengths differ by label."""
    rows = table(spark, folder, "embeddings")
    # A search is work for all cores, however few parts or row groups the file has.
    parts = max(rows.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    scaled = F.transform(
        "embedding", lambda x: (x.cast("double") * (1 + F.col("label") / 10)).cast("float")
    )
    # Scaled once, as a search reads the corpus for each wave of questions.
    dealt = rows.repartition(parts).select(F.col("vec_id").alias("id"), scaled.alias("embedding"))
    return rows.select(F.col("vec_id").alias("qid"), "embedding"), materialise(dealt, "vectors")


def shown(ranked: DataFrame) -> DataFrame:
    # Adding zero turns -0.0 into 0.0.
    return ranked.select("qid", "rank", "id", (F.round("dist", 6) + F.lit(0.0)).alias("dist"))


def fresh_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


def page_files(spark: SparkSession, folder: str, columns: bool = False) -> DataFrame:
    """PDF files of the words of every page, in the styles of two writers."""
    words = text.words(parse.html_text(F.col("content")))
    file = write_pdf(words, F.col("page_id"), columns).alias("content")
    return raw_pages(spark, folder).select("page_id", "path", F.col("content").alias("html"), file)


# -- sources -----------------------------------------------------------------------


@query
def list_documents(spark, folder):
    return files.list_documents(spark, folder, "*.parquet").select("name", "length")


@query
def scan_documents_glob(spark, folder):
    scanned = files.scan_documents(spark, folder, "*s.parquet")
    return scanned.select(
        text.basename(F.col("path")).alias("name"), "length", F.md5("content").alias("digest")
    )


@query
def stream_ingest_files(spark, folder):
    name = fresh_name("raw_files")
    ingest.ingest_files(
        spark,
        folder,
        name,
        checkpoint=scratch_path(spark, "checkpoint"),
        glob="*.parquet",
        path=scratch_path(spark, "raw_files"),
        piece_bytes=files.PIECE_BYTES,
    )
    digests = files.piece_digests(spark.read.table(name), "writer", "batch_id")
    return digests.select(text.basename(F.col("path")).alias("name"), "length", "digest")


@query
def stream_chunk_embed(spark, folder):
    raw, chunks = fresh_name("raw_pages"), fresh_name("page_chunks")
    tables.create_table(
        spark,
        raw,
        "page_id BIGINT, path STRING, content BINARY",
        path=scratch_path(spark, "raw_pages"),
    )
    tables.append_by_name(raw_pages(spark, folder), raw)
    ingest.ingest_chunks(
        spark,
        raw,
        chunks,
        checkpoint=scratch_path(spark, "checkpoint"),
        embedder=EMBEDDER,
        chunks=page_text_chunks(F.col("content")),
        path=scratch_path(spark, "page_chunks"),
        documents_per_arrow_batch=None,
    )
    return spark.read.table(chunks).select(
        "id", "url", "content", F.size("embedding").alias("dim")
    )


@query
def table_preview(spark, folder):
    name = fresh_name("documents")
    table(spark, folder, "documents").createOrReplaceTempView(name)
    return tables.select_all(spark, name)


@query
def page_image_map(spark, folder):
    return files.page_images(table(spark, folder, "pages"), F.col("url"), r"/(\d+)(?:/|\.html)?(?:[?#].*)?$")


# -- tables ------------------------------------------------------------------------


@query
def chunk_ids_hash(spark, folder):
    pieces = chunk.explode_chunks(
        documents(spark, folder), chunk.stride_chunks(F.col("text")), "doc_id"
    )
    return pieces.select(
        ids.hash_id(F.col("doc_id"), F.col("chunk_ix")).alias("id"), "doc_id", "chunk_ix"
    )


@query
def chunk_ids_dense(spark, folder):
    pieces = chunk.explode_chunks(
        documents(spark, folder), chunk.stride_chunks(F.col("text")), "doc_id"
    )
    keyed = pieces.select("doc_id", "chunk_ix")
    return ids.with_dense_ids(keyed, ["doc_id", "chunk_ix"])


def snapshots(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Two states of the document table: one language is new in the second, one is
    gone, and one has been cleaned."""
    texts = table(spark, folder, "documents").select("doc_id", "lang", "text")
    cleaned = F.when(F.col("lang") == "fr", text.clean_section(F.col("text"))).otherwise(F.col("text"))
    old = texts.where(F.col("lang") != "de").select("doc_id", "text")
    new = texts.where(F.col("lang") != "es").select("doc_id", cleaned.alias("text"))
    return old, new


@query
def snapshot_changes(spark, folder):
    return changes.snapshot_changes(*snapshots(spark, folder), "doc_id")


@query
def stored_changes(spark, folder):
    """The same, from snapshots that are kept with their digests."""
    roots = []
    for rows in snapshots(spark, folder):
        roots.append(scratch_path(spark, "snapshot"))
        kept.write_snapshot(rows, "doc_id", roots[-1], buckets=32, branches=4)
    return kept.stored_changes(spark, *roots, "doc_id")


@query
def apply_changes(spark, folder):
    old, new = snapshots(spark, folder)
    first = changes.snapshot_changes(old, new, "doc_id").withColumn("version", F.lit(1))
    labels = table(spark, folder, "labels")
    second = labels.select(
        "doc_id",
        F.when(F.col("toxic") == 1, "delete").otherwise("update").alias("change"),
        F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("text"),
        F.lit(2).alias("version"),
    )
    return changes.apply_changes(old, first.unionByName(second), "doc_id", "version")


def page_collection(spark: SparkSession, folder: str) -> str:
    name = fresh_name("collection")
    ingest.index_documents(
        raw_pages(spark, folder),
        name,
        EMBEDDER,
        page_text_chunks(F.col("content")),
        metric="cosine",
        path=scratch_path(spark, "collection"),
    )
    return name


@query
def index_build(spark, folder):
    rows = tables.read_table(spark, page_collection(spark, folder))
    return rows.select("id", "uri", "document", F.size("embedding").alias("dim"))


@query
def sync_collection(spark, folder):
    """Fill a collection twice (the same rows, once), then bring it in step with changes."""
    name, where = fresh_name("synced"), scratch_path(spark, "synced")
    embedder = hashed_words(8)
    # Cheap to embed: not worth another shuffle of the texts.
    rows = documents(spark, folder, rows_per_task=None).select(
        F.col("doc_id").alias("id"), F.col("source").alias("url"), F.col("text").alias("content"),
        "lang",
    )
    vector = embed(F.col("content"), embedder).alias("embedding")
    tables.create_collection(spark, name, embedder.dim, embedder.name, path=where)
    for _ in range(2):
        tables.add_to_collection(rows.select("id", "url", "content", vector), name, embedder)
    changed = rows.where("lang IN ('de', 'fr')").withColumn(
        "change", F.when(F.col("lang") == "de", "delete").otherwise("update")
    )
    changed = changed.withColumn("content", F.concat(F.lit("again "), "content"))
    tables.sync_collection(
        changed.select("id", "change", "url", "content", vector), name, embedder
    )
    return spark.table(name).select("id", "uri", "document")


@query
def collection_search(spark, folder):
    name = page_collection(spark, folder)
    hits = answer.retrieve_from(name, questions(spark, folder), EMBEDDER, k=2)
    return hits.select("qid", "rank", "url", "content")


@query
def stream_answers(spark, folder):
    asked, chunks, log = (fresh_name(n) for n in ("questions", "chunks", "answers"))
    tables.create_table(
        spark, asked, "qid BIGINT, question STRING", path=scratch_path(spark, "questions")
    )
    tables.append_by_name(questions(spark, folder), asked)
    tables.create_chunk_table(spark, chunks, path=scratch_path(spark, "chunk_table"))
    tables.append_by_name(chunk_table(spark, folder).drop("page"), chunks)
    respond.answer_stream(
        spark.readStream.table(asked),
        chunks,
        log,
        scratch_path(spark, "checkpoint"),
        EMBEDDER,
        GENERATOR,
        path=scratch_path(spark, "answers"),
    )
    logged = spark.read.table(log).where(F.col("ts").isNotNull())
    return logged.select(
        "request_id", "question", "answer", F.array_join("sources", ",").alias("sources")
    )


@query
def inference_log(spark, folder):
    log = tables.inference_log(all_answers(spark, folder))
    return log.withColumn("sources", F.array_join("sources", ","))


@query
def log_to_json(spark, folder):
    log = tables.log_as_json(tables.inference_log(all_answers(spark, folder)))
    sent = F.from_json("request", "messages array<struct<role:string,content:string>>")
    return log.withColumn("question", sent["messages"][0]["content"])


# -- projections and filters -------------------------------------------------------


@query
def chunk_projection(spark, folder):
    pieces = chunk.explode_chunks(
        raw_pages(spark, folder), page_text_chunks(F.col("content")), "path"
    )
    return pieces.selectExpr("path as url", "content")


@query
def exclude_by_name(spark, folder):
    named = table(spark, folder, "pages").select("page_id", text.basename(F.col("url")).alias("name"))
    return files.exclude_by_name(named, F.col("name"), "ref=")


@query
def url_basename(spark, folder):
    return table(spark, folder, "pages").select("page_id", text.basename(F.col("url")).alias("name"))


@query
def question_guard(spark, folder):
    # Each text as it is, and with everything but its white space taken out.
    asked = table(spark, folder, "benchmark").select(
        "item_id",
        F.posexplode(
            F.array("text", F.regexp_replace("text", "[^ \t\r\n]", ""), F.lit("  "))
        ).alias("variant", "question"),
    )
    return asked.select(
        "item_id", "variant", text.guarded(F.col("question"), F.col("question")).alias("reply")
    )


@query
def json_field(spark, folder):
    # Some rows get each of the keys that are looked for.
    more = F.when(F.col("event_id") % 3 == 0, ', "ready": "yes"}').when(
        F.col("event_id") % 3 == 1, ', "error_code": 7}'
    )
    filled = F.replace("props", F.lit("}"), F.coalesce(more, F.lit("}")))
    props = F.from_json(filled, "map<string,string>")
    parsed = table(spark, folder, "events").select("event_id", props.alias("props"))
    return parsed.select(
        "event_id",
        F.col("props")["k"].cast("int").alias("k"),
        F.col("props")["ready"].alias("ready"),
        F.map_contains_key("props", "error_code").alias("has_error"),
    )


@query
def limit_questions(spark, folder):
    asked = table(spark, folder, "benchmark").withColumnRenamed("text", "question")
    limits = [
        answer.limit_questions(asked, "item_id", n).select(F.lit(n).alias("n"), "question")
        for n in (50, 7)
    ]
    return limits[0].unionByName(limits[1])


# -- elements ----------------------------------------------------------------------


@query
def parse_elements(spark, folder):
    return page_elements(spark, folder)


@query
def element_slice(spark, folder):
    return parse.slice_elements(page_elements(spark, folder), 7, 12)


@query
def element_at(spark, folder):
    return parse.element_at(page_elements(spark, folder), 8)


@query
def element_type_counts(spark, folder):
    return parse.element_type_counts(page_elements(spark, folder))


@query
def split_examples(spark, folder):
    # Lines set apart by blank lines, as a model lists its examples.
    replies = spread(table(spark, folder, "conversations")).select(
        "conv_id", "turn", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("result")
    )
    return answer.split_answers(replies, "conv_id", "turn")


@query
def clean_section(spark, folder):
    # The texts have no space before a dot, so a second column puts one there.
    spaced = F.replace("text", F.lit("."), F.lit(" ."))
    return documents(spark, folder).select(
        "doc_id",
        text.clean_section(F.col("text")).alias("cleaned"),
        text.clean_section(spaced, " ").alias("spaced"),
    )


@query
def extract_doc_text(spark, folder):
    return raw_pages(spark, folder).select(
        "page_id", parse.html_text(F.col("content")).alias("text")
    )


@query
def page_texts(spark, folder):
    return page_texts_of(spark, folder)


@query
def load_and_split(spark, folder):
    texts = page_texts_of(spark, folder)
    return chunk.explode_chunks(
        texts, chunk.recursive_chunks(F.col("text")), "page_id", "page_number"
    )


# -- chunks and vectors ------------------------------------------------------------


@query
def chunk_sentences(spark, folder):
    return chunk.explode_chunks(
        documents(spark, folder), chunk.sentence_chunks(F.col("text")), "doc_id"
    )


@query
def chunk_recursive(spark, folder):
    return chunk.explode_chunks(
        documents(spark, folder), chunk.recursive_chunks(F.col("text")), "doc_id"
    )


@query
def chunk_stride(spark, folder):
    return chunk.explode_chunks(
        documents(spark, folder), chunk.stride_chunks(F.col("text")), "doc_id"
    )


@query
def explode_chunks(spark, folder):
    return chunk.explode_chunks(
        raw_pages(spark, folder), page_text_chunks(F.col("content")), "page_id"
    ).drop("n_units")


@query
def token_count(spark, folder):
    return documents(spark, folder).select(
        "doc_id", text.token_count(F.col("text")).alias("n_tokens")
    )


@query
def embed_chunks(spark, folder):
    pieces = chunk.explode_chunks(
        documents(spark, folder), chunk.stride_chunks(F.col("text")), "doc_id"
    )
    vector = embed(F.col("content"), EMBEDDER)
    weights = explode_once(pieces, vector, "doc_id", "chunk_ix", pos="bucket", item="weight")
    return weights.where(F.col("weight") > 0).withColumn(
        "weight", F.round(F.col("weight").cast("double"), 6)
    )


@query
def embed_hash_tf(spark, folder):
    vector = embed(F.col("text"), EMBEDDER)
    rows = documents(spark, folder)
    weights = explode_once(rows, vector, "doc_id", pos="bucket", item="weight")
    return weights.where(F.col("weight") > 0).withColumn(
        "weight", F.round(F.col("weight").cast("double"), 6)
    )


@query
def batch_assign(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id")
    return ids.request_batches(rows, ["doc_id"])


# -- retrieval ---------------------------------------------------------------------


@query
def topk_l2(spark, folder):
    return shown(nearest.nearest(*vectors(spark, folder), k=4))


@query
def topk_k2(spark, folder):
    return shown(nearest.nearest(*vectors(spark, folder), k=2))


@query
def topk_k3(spark, folder):
    return shown(nearest.nearest(*vectors(spark, folder), k=3))


@query
def topk_cosine(spark, folder):
    return shown(nearest.nearest(*vectors(spark, folder), k=4, metric="cosine"))


@query
def topk_ip(spark, folder):
    return shown(nearest.nearest(*vectors(spark, folder), k=4, metric="ip"))


@query
def topk_blocks(spark, folder):
    # Limits so low that the questions are sent block by block, as many are.
    limits = {"question_bytes": 1 << 17, "block_bytes": 1 << 16}
    return shown(nearest.nearest(*vectors(spark, folder), k=4, **limits))


@query
def topk_mmr(spark, folder):
    return shown(diverse.diverse(*vectors(spark, folder), k=4, fetch_k=12))


@query
def topk_pq(spark, folder):
    asked, corpus = vectors(spark, folder)
    return shown(quantise.search_codes(quantise.build_codes(corpus), asked, k=4))


@query
def topk_ivf(spark, folder):
    asked, corpus = vectors(spark, folder)
    cells = index.build_cells(corpus, cells=16)
    return shown(index.search_cells(cells, asked, k=4, probes=4))


@query
def topk_stored(spark, folder):
    """An index is written, opened again by its folder, and searched."""
    asked, corpus = vectors(spark, folder)
    root = scratch_path(spark, "index")
    stored.create_index(corpus, root, cells=16)
    return shown(stored.search_index(stored.open_index(spark, root), asked, k=4))


@query
def sync_index(spark, folder):
    """Rows of one label come later, those of another go, and a third is moved."""
    asked, corpus = vectors(spark, folder)
    label = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "label")
    rows, root = corpus.join(label, "id"), scratch_path(spark, "index")
    stored.create_index(rows.where("label <> 2"), root, cells=16)
    moved = F.transform("embedding", lambda x: (-x).cast("float"))
    changes = rows.where("label IN (0, 1, 2)").select(
        "id",
        F.expr("CASE label WHEN 0 THEN 'delete' WHEN 1 THEN 'update' ELSE 'insert' END").alias("change"),
        F.when(F.col("label") == 1, moved).otherwise(F.col("embedding")).alias("embedding"),
    )
    return shown(stored.search_index(stored.sync_index(changes, root), asked, k=4))


@query
def qa_index(spark, folder):
    """The answers of ``qa_batch``, the chunks found by a stored index."""
    chunks, root = chunk_table(spark, folder), scratch_path(spark, "index")
    opened = stored.create_index(chunks.select("id", "embedding"), root, cells=32)
    answers = answer.answer_questions(
        questions(spark, folder),
        chunks,
        EMBEDDER,
        GENERATOR,
        search=lambda asked, k: stored.search_index(opened, asked, k),
    )
    return answers.withColumn("sources", F.array_join("sources", ","))


@query
def topk_lsh(spark, folder):
    asked, corpus = vectors(spark, folder)
    return shown(index.search_buckets(asked, corpus, k=4))


@query
def retrieve_documents(spark, folder):
    hits = all_hits(spark, folder)
    return hits.select("qid", "rank", "id", "url", "content")


@query
def answer_sources(spark, folder):
    sources = answer.answer_sources(all_hits(spark, folder))
    return sources.select("qid", F.array_join("sources", ",").alias("sources"))


@query
def source_summary(spark, folder):
    return answer.source_summary(all_hits(spark, folder))


@query
def build_prompt(spark, folder):
    asked = questions(spark, folder)
    return answer.build_prompts(asked, all_hits(spark, folder)).select("qid", "prompt")


@query
def answer_questions(spark, folder):
    return all_answers(spark, folder).select("qid", "result")


@query
def qa_batch(spark, folder):
    answered = all_answers(spark, folder, parallel=5)
    return answered.withColumn("sources", F.array_join("sources", ","))


@query
def format_answer(spark, folder):
    # Answers with line breaks; once with the sources found, once without any.
    answered = all_answers(spark, folder).withColumn(
        "result", F.replace("result", F.lit(" "), F.lit("\n"))
    )
    none = answered.withColumn("sources", F.array().cast("array<string>"))
    bare = answer.format_answers(none).withColumnRenamed("html", "html_without_sources")
    return answer.format_answers(answered).join(bare, "qid")


@query
def render_conversation(spark, folder):
    return chat.render_conversations(table(spark, folder, "conversations"))


# -- checks ------------------------------------------------------------------------


@query
def count_chunks(spark, folder):
    pieces = chunk.explode_chunks(
        documents(spark, folder), chunk.stride_chunks(F.col("text")), "doc_id"
    )
    return pieces.agg(F.count("*").alias("n_chunks"))


@query
def table_complete(spark, folder):
    name = fresh_name("documents")
    rows = table(spark, folder, "documents")
    rows.createOrReplaceTempView(name)
    expected = table(spark, folder, "benchmark").count()
    complete = tables.table_complete(spark, name, expected)
    missing = tables.table_complete(spark, fresh_name("missing"), expected)
    return rows.agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        F.lit(expected).cast("bigint").alias("n_expected"),
        F.lit(complete).alias("complete"),
        F.lit(missing).alias("missing_complete"),
    )


# -- PDF files ---------------------------------------------------------------------


@query
def parse_pdf(spark, folder):
    files = page_files(spark, folder)
    elements = parse.element_rows(files, pdf.pdf_elements(F.col("content")), "page_id")
    return ordered_concat(elements, ["page_id", "page_number"], "pos", F.col("text"), " ", "text")


@query
def parse_mixed(spark, folder):
    """Every third page as HTML, the others as PDF: each is read by what it is."""
    own = F.when(F.col("page_id") % 3 == 0, F.col("html")).otherwise(F.col("content"))
    rows = page_files(spark, folder).select("page_id", own.alias("content"))
    texts = rows.select(
        "page_id",
        pdf.is_pdf(F.col("content")).alias("pdf"),
        pdf.document_elements(F.col("content")).alias("found"),
    )
    # The words in the files have been cleaned before.
    drawn = F.array_join(F.transform("found", lambda e: e["text"]), " ")
    whole = F.when(F.col("pdf"), drawn).otherwise(parse.elements_text(F.col("found")))
    return texts.select("page_id", "pdf", F.array_join(text.words(whole), " ").alias("text"))


@query
def reading_order(spark, folder):
    elements = parse.element_rows(
        page_files(spark, folder, columns=True),
        pdf.pdf_elements(F.col("content"), "hi_res"),
        "page_id",
    )
    return elements.select(
        "page_id", "page_number", "pos", "text", F.col("metadata")["text_as_html"].alias("table")
    )


# -- chat pages --------------------------------------------------------------------

AVATAR = "https://example.net/robot.png"


@query
def chat_page(spark, folder):
    """Every conversation with the answer to the question of its number, if there is one."""
    answers = all_answers(spark, folder).withColumnRenamed("qid", "conv_id")
    return chat.chat_pages(table(spark, folder, "conversations"), answers, avatar_url=AVATAR)
