"""The registered queries, each over whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askquarry.functions import prompts
from askquarry.functions.hashing import DEFAULT_DIM, hash_embed, model_name
from askquarry.functions.text import html_to_text, words
from askquarry.operators import cells, chat, chunking, classify, cleaning, plugins, records, search
from askquarry.operators.vector_table import VectorTable
from askquarry.plans import answers, ingest, standins
from askquarry.session import materialize, scratch_path, ship_package, spread
from askquarry.sources import corpus
from askquarry.streaming import drain

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed parameters, shared with sql.py.
QUESTION = "Which shelf holds the maps of the coast?"
TOPIC = "data platforms"
NAMESPACE = "documents"
MIN_DOCS = 5
BUDGET = 1200
HISTORY_WORDS = 1500
SHORTLIST = 10


def label_space():
    return F.concat(F.lit("label-"), F.col("label").cast("string"))


def query(fn: Query) -> Query:
    """Register under the function's name, less a trailing underscore."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__.rstrip("_")] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- inputs -------------------------------------------------------------------------


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as (url, content)."""
    return spread(stored_documents(spark, sf_dir))


def stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without spreading, for queries that do little per row."""
    url = F.concat_ws("/", "source", F.col("doc_id").cast("string"))
    return corpus.documents(table(spark, sf_dir, "documents"), url, "text")


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The web pages as (url, content), markup removed."""
    return corpus.documents(spread(table(spark, sf_dir, "pages")), "url", html_to_text(F.col("html")))


def document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.chunk_table(documents(spark, sf_dir))


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' part of a vector table, written once and then searched."""
    store = VectorTable(spark, scratch_path(spark, "document-records"))
    store.upsert(ingest.records_from_documents(documents(spark, sf_dir), NAMESPACE))
    return store.current(NAMESPACE)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("values"), "label"
    )


def labelled_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors as chunk rows with their label."""
    return vectors(spark, sf_dir).select(
        F.col("id").cast("string").alias("id"),
        F.concat(F.lit("class/"), F.col("label").cast("string")).alias("url"),
        F.concat(F.lit("vector "), F.col("id").cast("string")).alias("content"),
        F.col("values").alias("embedding"),
        "label",
    )


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query vector per class: its mean."""
    means = classify.class_centroids(vectors(spark, sf_dir), "label", "values")
    return means.select(F.col("label").cast("bigint").alias("qid"), F.col("centroid").alias("vector"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.requests_from_turns(table(spark, sf_dir, "conversations"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests for stages that read the question and the message before it."""
    return chat.questions_from_turns(table(spark, sf_dir, "conversations"))


def questions_with_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests with as much of their history as goes into a prompt."""
    return chat.questions_from_turns(table(spark, sf_dir, "conversations"), window_words=HISTORY_WORDS)


def split_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.split_messages(requests(spark, sf_dir))


def judge(spark: SparkSession, sf_dir: str) -> answers.Stage:
    """Verdict stage: is the question with its history closer to documents of good quality than to the others?"""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    graded = docs.join(table(spark, sf_dir, "labels"), "doc_id").select("text", "quality")
    centroids = classify.class_centroids(hash_embed(graded, "text", "values"), "quality", "values")

    def run(df: DataFrame) -> DataFrame:
        told = df.withColumn("_told", chat.with_history_text(df))
        judged = classify.nearest_class(hash_embed(told, "_told", "_values"), centroids, "_values", "_quality")
        verdict = F.when(F.col("_quality") == 1, "Yes.").when(F.col("_quality") == 0, "No.")
        return judged.withColumn("verdict", verdict).drop("_told", "_values", "_quality")

    return run


def plan(spark: SparkSession, sf_dir: str, **options) -> answers.AnswerPlan:
    """Answers by a model that is sent the prompt with documents and history."""
    reader = answers.model_stage(standins.reading_model, prompts.WITH_CONTEXT, "answer", carry=["request_id", "sources"])
    return answers.AnswerPlan(judge=judge(spark, sf_dir), topic=TOPIC, answer=reader, **options)


def big(column: str):
    return F.col(column).cast("bigint").alias(column)


# --- sources and sinks --------------------------------------------------------------


@query
def drain_once(spark, sf_dir):
    root = scratch_path(spark, "drain-once")
    for source, url, content in [
        ("documents", F.concat_ws("/", "source", F.col("doc_id").cast("string")), "text"),
        ("pages", "url", html_to_text(F.col("html"))),
    ]:
        schema = table(spark, sf_dir, source).schema
        for _ in range(2):  # the second run finds nothing new
            # A pattern, since a streamed table may be one file or a folder of files.
            stream = drain.stream_table(spark, f"{sf_dir}/{source}.parquet*", schema)
            drain.drain(corpus.documents(stream, url, content), root, source)
    landed = drain.drained(spark, root, "documents", "pages")
    return landed.select("url", F.md5("content").alias("content_md5"))


@query
def merged_corpus(spark, sf_dir):
    web_pages(spark, sf_dir).createOrReplaceTempView("askquarry_web_pages")
    found = [corpus.optional_table(spark, name) for name in ("askquarry_web_pages", "askquarry_no_such_table")]
    merged = corpus.merge_corpora([documents(spark, sf_dir), *found])
    return merged.select("url", F.md5("content").alias("content_md5"))


@query
def chunk_ids(spark, sf_dir):
    chunks = chunking.with_chunk_id(chunking.chunk_documents(documents(spark, sf_dir)))
    return chunks.select("id", "url", big("chunk_no"))


@query
def vector_upsert(spark, sf_dir):
    rows = labelled_chunks(spark, sf_dir)
    store = VectorTable(spark, scratch_path(spark, "vector-table"))
    store.upsert(records.vector_records(rows, label_space()), gather=True)
    changed = rows.filter("label = 3").withColumns(
        {"embedding": F.reverse("embedding"), "content": F.concat(F.lit("revised "), F.col("content"))}
    )
    added = rows.filter("label = 5").withColumn("id", F.concat(F.lit("copy-"), F.col("id")))
    update = records.vector_records(changed.unionByName(added), label_space())
    load = store.upsert(update)
    store.delete(records.vector_records(rows.filter("label = 7"), label_space()))
    store.upsert(update, load)  # a retried load changes nothing, nor does it outlive a later delete
    store.delete(records.vector_records(added.filter("id like 'copy-%9'"), label_space()))
    store.upsert(update, load)
    store.compact()
    store.upsert(update, load)  # known to the compacted table
    live = store.current()
    return live.select(
        "namespace",
        "id",
        F.get("values", F.lit(0)).cast("double").alias("first_value"),
        records.read_payload(F.col("metadata"))["content"].alias("content"),
    )


@query
def chunk_changes(spark, sf_dir):
    """Before: chunks of the labelled documents. After: all but toxic ones, junk marks removed."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")

    def snapshot(rows, text):
        url = F.concat_ws("/", "source", F.col("doc_id").cast("string"))
        return chunking.with_chunk_id(chunking.chunk_documents(corpus.documents(rows, url, text)))

    before = snapshot(docs.join(labels, "doc_id", "left_semi"), "text")
    toxic = labels.filter("toxic = 1")
    after = snapshot(docs.join(toxic, "doc_id", "left_anti"), F.regexp_replace("text", "[#*%]+", ""))
    return records.changes(before, after)


@query
def ingest_stream(spark, sf_dir):
    """The whole load as streams: two corpora, each with its own checkpoint, into one vector table."""
    root = scratch_path(spark, "ingest-stream")
    store = VectorTable(spark, f"{root}/vectors")
    for source, url, content in [
        ("documents", F.concat_ws("/", "source", F.col("doc_id").cast("string")), "text"),
        ("pages", "url", html_to_text(F.col("html"))),
    ]:
        schema = table(spark, sf_dir, source).schema
        for _ in range(2):  # the second run finds nothing new
            drain.drain_to_vectors(
                drain.stream_table(spark, f"{sf_dir}/{source}.parquet*", schema),
                store,
                drain.checkpoint_path(root, source, "vectors"),
                lambda batch: ingest.records_from_documents(
                    corpus.documents(spread(batch), url, content), NAMESPACE
                ),
            )
    live = store.current(NAMESPACE)
    return live.select("namespace", "id", F.md5("metadata").alias("metadata_md5"))


# --- projections and records --------------------------------------------------------


@query
def corpus_project(spark, sf_dir):
    return stored_documents(spark, sf_dir).select("url", F.length("content").cast("bigint").alias("n_chars"))


@query
def url_like(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url")
    return corpus.url_like(rows, "%/en/%", 10)


@query
def record_count(spark, sf_dir):
    return ingest.records_from_documents(documents(spark, sf_dir), NAMESPACE).agg(
        F.count(F.lit(1)).alias("n_records")
    )


@query
def vector_records(spark, sf_dir):
    shaped = records.vector_records(document_chunks(spark, sf_dir), NAMESPACE)
    return shaped.select(
        "id",
        "namespace",
        "metadata",
        F.size("values").cast("bigint").alias("n_values"),
        F.get("values", F.lit(0)).cast("double").alias("first_value"),
        F.col("sparse_values").isNull().alias("no_sparse_values"),
    )


@query
def payload_json(spark, sf_dir):
    chunks = chunking.with_chunk_id(chunking.chunk_documents(documents(spark, sf_dir)))
    return chunks.select("id", records.payload_json(F.col("content"), F.col("url"), F.col("id")).alias("metadata"))


@query
def payload_lookup(spark, sf_dir):
    stored = payload_json(spark, sf_dir).withColumn("payload", records.read_payload(F.col("metadata")))
    return stored.select("id", F.col("payload.url").alias("url"), F.col("payload.content").alias("content"))


@query
def original_doc_json(spark, sf_dir):
    return stored_documents(spark, sf_dir).select("url", records.original_doc_json(F.col("content")).alias("metadata"))


@query
def embedding_dim(spark, sf_dir):
    return records.embedding_sizes(vectors(spark, sf_dir))


@query
def latest_version(spark, sf_dir):
    """Newest assistant turn of each conversation, turn numbers read as version strings."""
    turns = table(spark, sf_dir, "conversations").withColumn("version", F.col("turn").cast("string"))
    return records.latest_versions(turns, turns.filter("role = 'assistant'"), "conv_id", "version", "text")


# --- text and chunks ----------------------------------------------------------------


@query
def html_text(spark, sf_dir):
    return web_pages(spark, sf_dir)


@query
def extract_documents(spark, sf_dir):
    """Decode the documents' bytes with a plug-in that fails on some; failures keep their reason."""
    raw = documents(spark, sf_dir).select("url", F.encode("content", "UTF-8").alias("content"))
    read = plugins.extract_text(raw, "content", standins.pages_of_paragraphs)
    return read.select("url", F.md5("text").alias("text_md5"), "error")


@query
def chunk_drop_failed(spark, sf_dir):
    """Chunks per document, where extraction fails on documents with a junk mark."""
    raw = documents(spark, sf_dir).select("url", F.encode("content", "UTF-8").alias("content"))
    read = plugins.extract_text(raw, "content", standins.pages_of_paragraphs)
    chunks = chunking.chunk_documents(read.select("url", F.col("text").alias("content")))
    return chunks.groupBy("url").agg(F.count(F.lit(1)).alias("n_chunks"))


@query
def chunk_window(spark, sf_dir):
    chunks = chunking.chunk_documents(documents(spark, sf_dir))
    return chunks.select("url", big("chunk_no"), "content")


@query
def chunk_sentences(spark, sf_dir):
    chunks = chunking.chunk_documents(documents(spark, sf_dir), method="sentence")
    return chunks.select("url", big("chunk_no"), "content")


@query
def chunk_splitter(spark, sf_dir):
    """Chunking by a plug-in splitter, here one chunk per paragraph."""
    split = plugins.split_texts(documents(spark, sf_dir), "content", standins.paragraph_splitter)
    chunks = chunking.explode_chunks(split.drop("content"), "chunks")
    return chunks.select("url", big("chunk_no"), "content")


@query
def boilerplate_lines(spark, sf_dir):
    return cleaning.boilerplate_lines(documents(spark, sf_dir), min_docs=MIN_DOCS)


@query
def boilerplate_removed(spark, sf_dir):
    docs = documents(spark, sf_dir)
    cleaned = cleaning.drop_lines(docs, cleaning.boilerplate_lines(docs, min_docs=MIN_DOCS), "url")
    return cleaned.select("url", F.md5("content").alias("content_md5"))


@query
def context_budget(spark, sf_dir):
    found = retrieved(spark, sf_dir).withColumn("n_tokens", F.size(words(F.col("content"))).cast("bigint"))
    kept = chunking.within_budget(found, "request_id", "rank", "n_tokens", BUDGET)
    return kept.select("request_id", "rank", "n_tokens", big("used_tokens"))


# --- embedding ----------------------------------------------------------------------


def _entries(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Non-zero vector entries as rows; taken inside the vector, so that it is made once."""
    weights = F.transform(F.col(vector), lambda w, i: F.struct(i.cast("bigint").alias("bucket"), F.round(w.cast("double"), 6).alias("weight"), (w != 0).alias("full")))
    each = df.select(key, F.explode(F.filter(weights, lambda e: e["full"])).alias("e"))
    return each.select(key, "e.bucket", "e.weight")


@query
def hash_embed_(spark, sf_dir):
    return _entries(document_chunks(spark, sf_dir), "id", "embedding")


@query
def embed_batches(spark, sf_dir):
    chunks = chunking.with_chunk_id(chunking.chunk_documents(documents(spark, sf_dir)))
    embedded = plugins.embed_texts(
        chunks.select("id", "content"), "content", standins.hash_model, model_name(DEFAULT_DIM), DEFAULT_DIM
    )
    return _entries(embedded, "id", "embedding")


@query
def embed_query(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return _entries(hash_embed(items, "text"), "item_id", "embedding")


# --- search -------------------------------------------------------------------------


@query
def topk_single(spark, sf_dir):
    asked = spark.createDataFrame([(QUESTION,)], "question string")
    vector = hash_embed(asked, "question").first()["embedding"]
    rows = document_records(spark, sf_dir)
    return search.with_payload(search.topk_one(rows, vector, 5), rows).select("id", "url", "score")


def _vector_search(spark, sf_dir, metric: str) -> DataFrame:
    corpus_vectors = spread(vectors(spark, sf_dir))
    return search.topk(corpus_vectors, vector_queries(spark, sf_dir), 5, metric, dim=DEFAULT_DIM)


@query
def topk_batch(spark, sf_dir):
    return _vector_search(spark, sf_dir, "cosine")


@query
def topk_dot(spark, sf_dir):
    return _vector_search(spark, sf_dir, "dot")


@query
def topk_l2(spark, sf_dir):
    return _vector_search(spark, sf_dir, "l2")


@query
def topk_blocks(spark, sf_dir):
    """The form for query sets too large to broadcast: in batches."""
    return search.topk(
        vectors(spark, sf_dir), vector_queries(spark, sf_dir), 5, dim=DEFAULT_DIM, broadcast_queries=4
    )


@query
def topk_ivf(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    index = cells.build_cells(rows, DEFAULT_DIM, n_cells=16)
    return cells.topk_cells(index, vector_queries(spark, sf_dir), 5, probes=2, exact=True)


@query
def topk_ivf_probed(spark, sf_dir):
    """Approximate form: short lists by codes, whose vectors alone are read."""
    rows = vectors(spark, sf_dir)
    index = cells.build_cells(rows, DEFAULT_DIM, n_cells=16)
    return cells.topk_coded(index, vector_queries(spark, sf_dir), 5, probes=14, shortlist=SHORTLIST)


@query
def ivf_recall(spark, sf_dir):
    """Whether the approximate form finds nine of ten matches, with as few vectors read as its short lists hold."""
    rows, asked = vectors(spark, sf_dir), materialize(vector_queries(spark, sf_dir), "recall-queries")
    index = cells.build_cells(rows, DEFAULT_DIM, n_cells=16)
    some = cells.topk_coded(index, asked, 5, probes=14, shortlist=SHORTLIST).select("qid", "id", F.lit(1).alias("hit"))
    exact = search.topk(rows, asked, 5, dim=DEFAULT_DIM).select("qid", "id")
    met = exact.join(some, ["qid", "id"], "left").agg(F.count(F.lit(1)).alias("n_matches"), F.count("hit").alias("n_found"))
    few = rows.agg(F.count(F.lit(1)).alias("n_vectors"))
    return met.join(F.broadcast(few), F.lit(True)).select(
        "n_matches",
        (F.col("n_found") >= 0.9 * F.col("n_matches")).alias("recall_reached"),
        (F.lit(SHORTLIST) * F.col("n_matches") / 5 <= F.col("n_vectors") / 4).alias("a_quarter_read_at_most"),
    )


@query
def topk_namespace(spark, sf_dir):
    """Search within one namespace of a stored vector table; its other folders are not read."""
    store = VectorTable(spark, scratch_path(spark, "namespaces"))
    store.upsert(records.vector_records(labelled_chunks(spark, sf_dir), label_space()), gather=True)
    inside = store.current("label-3").withColumn("id", F.col("id").cast("bigint"))
    return search.topk(inside, vector_queries(spark, sf_dir), 5, dim=DEFAULT_DIM)


def _benchmark_queries(spark, sf_dir) -> DataFrame:
    items = hash_embed(table(spark, sf_dir, "benchmark"), "text", "vector")
    return items.select(F.col("item_id").alias("qid"), "vector")


@query
def topk_with_payload(spark, sf_dir):
    rows = document_records(spark, sf_dir)
    matches = search.topk_records(rows, _benchmark_queries(spark, sf_dir), 5)
    return search.with_payload(matches, rows, include_values=True).select(
        "qid", "rank", "url", "content", "score", F.size("values").cast("bigint").alias("n_values")
    )


@query
def text_search(spark, sf_dir):
    rows = document_records(spark, sf_dir)
    matches = search.topk_records(rows, _benchmark_queries(spark, sf_dir), 3)
    return search.with_payload(matches, rows).select("qid", "rank", "url", "score")


@query
def topk_two_namespaces(spark, sf_dir):
    """The same ids in two namespaces, with other vectors and payloads: every match has its own."""
    rows = labelled_chunks(spark, sf_dir)
    store = VectorTable(spark, scratch_path(spark, "two-namespaces"), {"model": "given", "dim": DEFAULT_DIM})
    store.upsert(records.vector_records(rows, "plain"))
    turned = rows.withColumns({"embedding": F.reverse("embedding"), "content": F.concat(F.lit("turned "), F.col("content"))})
    store.upsert(records.vector_records(turned, "turned"))
    live = store.current()
    found = search.with_payload(search.topk_records(live, vector_queries(spark, sf_dir), 5), live)
    return found.select("qid", "rank", "namespace", "id", "content", "score")


def retrieved(spark, sf_dir) -> DataFrame:
    asked = questions(spark, sf_dir).select("request_id", F.col("question").alias("query"))
    return answers.retrieve(asked, document_records(spark, sf_dir), plan(spark, sf_dir))


@query
def retrieve(spark, sf_dir):
    return retrieved(spark, sf_dir).select("request_id", "rank", "url", "score")


# --- conversations and answers ------------------------------------------------------


@query
def assemble_messages(spark, sf_dir):
    whole = chat.assemble_messages(table(spark, sf_dir, "conversations"))
    return whole.select("conv_id", F.to_json("messages").alias("messages"))


@query
def late_turns(spark, sf_dir):
    """Turns beyond a limit of five messages per conversation."""
    late = chat.late_turns(table(spark, sf_dir, "conversations"), max_messages=5)
    return late.select("conv_id", "turn", "reason")


@query
def extract_question(spark, sf_dir):
    return questions(spark, sf_dir).select("request_id", "question")


@query
def extract_history(spark, sf_dir):
    rows = requests(spark, sf_dir).select("request_id", chat.extract_history(F.col("messages")).alias("history"))
    return rows.select(
        "request_id", F.size("history").cast("bigint").alias("n_messages"), F.to_json("history").alias("history")
    )


@query
def validate_requests(spark, sf_dir):
    """The histories taken as requests: openers have none and are rejected, with the reason."""
    sent = questions_with_history(spark, sf_dir).select("request_id", F.col("history").alias("messages"))
    good, bad = chat.validate_requests(materialize(sent, "sent-requests"))
    good = good.select("request_id", F.lit("ok").alias("outcome"), F.size("messages").cast("bigint").alias("n_messages"))
    return good.unionByName(bad.select("request_id", F.col("reason").alias("outcome"), F.size("messages").cast("bigint").alias("n_messages")))


@query
def render_prompt(spark, sf_dir):
    values = {
        "question": F.col("question"),
        "chat_history": prompts.history_text(F.col("history")),
        "topic": TOPIC,
        "context": F.col("question"),
    }
    names = {
        "plain": prompts.PLAIN,
        "with_history": prompts.WITH_HISTORY,
        "relevance": prompts.RELEVANCE,
        "search_query": prompts.SEARCH_QUERY,
        "with_context": prompts.WITH_CONTEXT,
    }
    rows = split_requests(spark, sf_dir)
    return rows.select("request_id", *[prompts.render(t, **values).alias(n) for n, t in names.items()])


@query
def generate_answers(spark, sf_dir):
    """A plug-in model over plain prompts; the stand-in gives back the prompt's last line, cut short."""
    rows = questions(spark, sf_dir)
    prompt = rows.select("request_id", prompts.render(prompts.PLAIN, question=F.col("question")).alias("prompt"))
    return plugins.generate_texts(
        prompt, "prompt", standins.echo_model, max_tokens=plugins.PLAIN_ANSWER_TOKENS
    ).select("request_id", "answer")


@query
def relevance_check(spark, sf_dir):
    return judge(spark, sf_dir)(questions_with_history(spark, sf_dir)).select("request_id", "verdict")


@query
def centroid_classify(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    centroids = classify.class_centroids(rows, "label", "values")
    return classify.nearest_class(spread(rows), centroids, "values").select("id", "label", "predicted")


@query
def route_requests(spark, sf_dir):
    judged = judge(spark, sf_dir)(questions_with_history(spark, sf_dir))
    judged = materialize(judged.withColumn("route", chat.route(F.col("verdict"))), "routed-requests")
    refused = chat.refusals(judged.filter("route = 'refuse'"), TOPIC)
    told = refused.select("request_id", "result", F.size("sources").cast("bigint").alias("n_sources"))
    passed = judged.filter("route = 'answer'").select(
        "request_id", F.lit(None).cast("string").alias("result"), F.lit(None).cast("bigint").alias("n_sources")
    )
    return told.unionByName(passed)


@query
def rewrite_query(spark, sf_dir):
    return answers.rewrite_queries(questions(spark, sf_dir), plan(spark, sf_dir)).select("request_id", "query")


@query
def format_context(spark, sf_dir):
    found = chat.gather_documents(retrieved(spark, sf_dir))
    return found.select("request_id", F.md5("context").alias("context_md5"), big_length("context"))


def big_length(column: str):
    return F.length(column).cast("bigint").alias("n_chars")


@query
def source_urls(spark, sf_dir):
    found = chat.gather_documents(retrieved(spark, sf_dir))
    return found.select("request_id", F.array_join("sources", "\n").alias("sources"))


@query
def answer_relevant(spark, sf_dir):
    """Every request answered, always searching with the rewritten query, embedded by a plug-in model."""
    rows = questions_with_history(spark, sf_dir)
    model = answers.model_embedding(standins.hash_model, model_name(DEFAULT_DIM), DEFAULT_DIM, "query", "vector")
    how = plan(spark, sf_dir, always_rewrite=True, embed=model)
    told = answers.answer_relevant(rows, document_records(spark, sf_dir), how)
    return told.select("request_id", "result", F.array_join("sources", "\n").alias("sources"))


@query
def rag_answers(spark, sf_dir):
    """Flagship: requests checked, judged, routed, and answered from documents and web pages."""
    both = corpus.merge_corpora([documents(spark, sf_dir), web_pages(spark, sf_dir)])
    store = VectorTable(spark, scratch_path(spark, "corpus-records"))
    store.upsert(ingest.records_from_documents(both, NAMESPACE))
    told = answers.answer_all(questions_with_history(spark, sf_dir), store.current(NAMESPACE), plan(spark, sf_dir))
    return told.select("request_id", "result", F.array_join("sources", "\n").alias("sources"), "reason")
