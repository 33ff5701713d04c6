"""From request rows to answers with sources."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askquarry.functions import prompts
from askquarry.functions.hashing import DEFAULT_DIM, hash_embed
from askquarry.functions.text import first_sentence, words
from askquarry.operators import chat, search
from askquarry.operators.chunking import within_budget
from askquarry.operators.plugins import ANSWER_TOKENS, LanguageModel, TextsTo, embed_texts, generate_texts
from askquarry.session import materialize

Stage = Callable[[DataFrame], DataFrame]


def hashed(text: str, out: str, dim: int = DEFAULT_DIM) -> Stage:
    """Stage that embeds with the built-in hashed words."""
    return lambda df: hash_embed(df, text, out, dim)


def model_embedding(factory: Callable[[], TextsTo], model: str, dim: int, text: str, out: str) -> Stage:
    """Stage that embeds with a caller-supplied model and writes the vectors out."""
    return lambda df: materialize(embed_texts(df, text, factory, model, dim, out), out)


def model_stage(
    factory: Callable[[], LanguageModel],
    template: str,
    out: str,
    slots: dict[str, str] | None = None,
    max_tokens: int = ANSWER_TOKENS,
    batch_size: int = 16,
    carry: list[str] | None = None,
) -> Stage:
    """Stage that renders a prompt and asks a caller-supplied language model.

    The result is written out, so a later retry or a second reader does not
    repeat the calls. ``slots`` gives fixed slot values such as the topic. ``carry`` names the columns that
    later stages read, all by default; documents and histories, which the prompt holds already, needn't be sent and written beside it.
    """

    def run(df: DataFrame) -> DataFrame:
        values = {"question": F.col("question")}
        if "history" in df.columns:
            values["chat_history"] = prompts.history_text(F.col("history"))
        if "context" in df.columns:
            values["context"] = F.col("context")
        prompt = prompts.render(template, **values, **(slots or {}))
        sent = df.select(*(df.columns if carry is None else carry), prompt.alias("_prompt"))
        asked = generate_texts(sent, "_prompt", factory, out, max_tokens, batch_size)
        return materialize(asked.drop("_prompt"), out)

    return run


def last_message_rewrite(df: DataFrame) -> DataFrame:
    """Offline rewrite stage."""
    return df.withColumn("query", chat.question_with_last_message(F.col("question"), chat.last_message(df)))


def first_sentence_answer(df: DataFrame) -> DataFrame:
    """Offline answer stage: first sentence of the best chunk."""
    return df.withColumn("answer", first_sentence(F.col("top_content")))


@dataclass
class AnswerPlan:
    """How requests are answered.

    ``judge`` adds ``verdict`` from question and history, ``rewrite`` adds ``query``,
    ``embed`` adds ``vector`` from ``query``, ``answer`` adds ``answer`` from
    context, question and history. ``find`` runs the search. ``context_words``
    limits the documents put into the prompt, so that it fits the model's window.
    """

    judge: Stage
    topic: str
    rewrite: Stage = last_message_rewrite
    embed: Stage = hashed("query", "vector")
    answer: Stage = first_sentence_answer
    k: int = search.DEFAULT_K
    always_rewrite: bool = False
    context_words: int | None = None
    find: Callable[[DataFrame, DataFrame, int], DataFrame] = search.topk_records


def rewrite_queries(requests: DataFrame, plan: AnswerPlan) -> DataFrame:
    """Add ``query``; only requests with a history reach the rewrite stage."""
    if plan.always_rewrite:
        return plan.rewrite(requests)
    followups = plan.rewrite(requests.filter(chat.has_history(requests)))
    openers = requests.filter(~chat.has_history(requests)).withColumn("query", F.col("question"))
    return followups.unionByName(openers)


def retrieve(queries: DataFrame, records: DataFrame, plan: AnswerPlan, key: str = "request_id") -> DataFrame:
    """Embed ``query``, search, and join the payload of the winners: one row per match."""
    embedded = plan.embed(queries.select(key, "query")).select(F.col(key).alias("qid"), "vector")
    matches = plan.find(records, embedded, plan.k)
    return search.with_payload(matches, records).withColumnRenamed("qid", key)


def answer_relevant(requests: DataFrame, records: DataFrame, plan: AnswerPlan) -> DataFrame:
    """Rewrite, retrieve, build the context and answer: ``(request_id, result, sources)``.

    A request for which nothing was found is still answered, from an empty context.
    """
    matches = retrieve(rewrite_queries(requests, plan), records, plan)
    if plan.context_words is not None:
        sized = matches.withColumn("n_words", F.size(words(F.col("content"))))
        matches = within_budget(sized, "request_id", "rank", "n_words", plan.context_words)
    found = chat.gather_documents(matches)
    ready = requests.join(found, "request_id", "left").withColumns(
        {
            "context": F.coalesce("context", F.lit("")),
            "sources": F.coalesce("sources", F.array().cast("array<string>")),
        }
    )
    return plan.answer(ready).select("request_id", F.col("answer").alias("result"), "sources")


def answer_requests(requests: DataFrame, records: DataFrame, plan: AnswerPlan) -> DataFrame:
    """Judge every request, answer the relevant ones and refuse the others.

    ``requests`` hold ``messages``, or are rows of ``chat.questions_from_turns``, with a window where a stage of the plan reads the history.
    The judged requests are written out, since both branches read them; refused
    requests never reach rewriting, search or the answering model.
    """
    judged = plan.judge(chat.split_messages(requests) if "messages" in requests.columns else requests)
    judged = materialize(judged.withColumn("route", chat.route(F.col("verdict"))), "routed-requests")
    answered = answer_relevant(judged.filter(F.col("route") == "answer"), records, plan)
    refused = chat.refusals(judged.filter(F.col("route") == "refuse"), plan.topic)
    return answered.unionByName(refused)


def answer_all(requests: DataFrame, records: DataFrame, plan: AnswerPlan) -> DataFrame:
    """``answer_requests`` with every request told of: ``(request_id, result, sources, reason)``.

    Requests that cannot be answered come back with the reason, no result and no sources. ``requests`` hold ``messages`` or
    are rows of ``chat.questions_from_turns``.
    """
    if "messages" in requests.columns:
        good, bad = chat.validate_requests(requests)
    else:
        known = requests.withColumn("reason", chat.question_problem())
        good, bad = known.filter(F.col("reason").isNull()).drop("reason"), known.filter(F.col("reason").isNotNull())
    told = answer_requests(good, records, plan).withColumn("reason", F.lit(None).cast("string"))
    nothing = F.lit(None).cast("string").alias("result"), F.array().cast("array<string>").alias("sources")
    return told.unionByName(bad.select("request_id", *nothing, "reason"))
