"""Conversations: messages, questions, histories, verdicts and answer parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from askquarry.functions import prompts
from askquarry.functions.text import words
from askquarry.session import materialize

# Request and answer layouts.
MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
MESSAGES = T.ArrayType(MESSAGE)
ANSWER = T.StructType(
    [T.StructField("result", T.StringType()), T.StructField("sources", T.ArrayType(T.StringType()))]
)

def _numbered(turns: DataFrame, conversation: str, turn: str, role: str, content: str) -> DataFrame:
    # in the order of the assembled messages, ties included
    order = Window.partitionBy(conversation).orderBy(turn, role, content)
    return turns.withColumn("_position", F.row_number().over(order))


def assemble_messages(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
    max_messages: int | None = None,
) -> DataFrame:
    """Turn rows to one ``messages`` array per conversation, in turn order; all of them unless a limit is asked for.

    With ``max_messages`` only the first ones are kept, before the shuffle; ``late_turns`` returns the others.
    """
    kept = turns
    if max_messages is not None:
        kept = _numbered(turns, conversation, turn, role, content).filter(F.col("_position") <= max_messages)
    message = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(content).alias("content"))
    ordered = F.array_sort(F.collect_list(message))
    return kept.groupBy(conversation).agg(ordered.alias("_turns")).select(
        conversation,
        F.transform("_turns", lambda m: m["turn"]).alias("turns"),
        F.transform("_turns", lambda m: F.struct(m["role"], m["content"])).cast(MESSAGES).alias("messages"),
    )


def late_turns(
    turns: DataFrame,
    max_messages: int,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
) -> DataFrame:
    """The turns beyond the first ``max_messages`` of their conversation, with the reason.

    Together with what ``assemble_messages`` keeps under the same limit these are all turns, also where several share a number.
    """
    late = _numbered(turns, conversation, turn, role, content).filter(F.col("_position") > max_messages)
    return late.drop("_position").withColumn("reason", F.lit("history_too_long"))


def requests_from_turns(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
    asker: str = "user",
    max_messages: int | None = None,
) -> DataFrame:
    """One request per user turn: ``(request_id, messages)`` with all turns up to it."""
    whole = assemble_messages(turns, conversation, turn, role, content, max_messages)
    asked = F.filter(
        F.transform("messages", lambda m, i: F.when(m["role"] == asker, i + 1)), lambda i: i.isNotNull()
    )
    each = whole.select(
        conversation, "turns", "messages", F.explode(F.coalesce(asked, F.array().cast("array<int>"))).alias("_n")
    )
    key = F.concat_ws("-", F.col(conversation), F.get("turns", F.col("_n") - 1))
    return each.select(key.alias("request_id"), F.slice("messages", F.lit(1), F.col("_n")).alias("messages"))


def _segments(rows: DataFrame) -> DataFrame:
    # a number given, so that adaptive execution doesn't gather them
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "c", "n", "role", "content")
    return materialize(dealt.withColumn("segment", F.spark_partition_id()), "turn-segments")


def questions_from_turns(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
    asker: str = "user",
    window_words: int | None = None,
) -> DataFrame:
    """The requests of ``requests_from_turns`` without their messages, for stages that need no whole history.

    ``(request_id, question, last_message, missing_role, missing_content)``: ``last_message`` is the message before the
    question, null if there is none; the flags tell whether any earlier message lacks its role or content.
    Turns are dealt by range into segments, so a long conversation is many tasks' work; only
    the end of a segment is carried into the next one.

    With ``window_words`` there is a ``history`` too: the messages before the question, as many of the latest as have so
    many words together (one without words counts as one), and the last message whatever its length. So
    histories grow with the turns and not with their square.
    """
    dealt = _segments(
        turns.select(
            F.col(conversation).alias("c"),
            F.col(turn).alias("n"),
            F.col(role).cast("string").alias("role"),
            F.col(content).cast("string").alias("content"),
        )
    )
    # places in the conversation, in words
    size = F.greatest(F.lit(1), F.coalesce(F.size(words(F.col("content"))), F.lit(1))).cast("bigint")
    dealt = dealt.withColumn("words", size if window_words else F.lit(0).cast("bigint"))
    message = F.struct("role", "content")
    no_role, no_content = F.col("role").isNull(), F.col("content").isNull()
    # in the order of the assembled messages, ties included
    order = Window.partitionBy("segment", "c").orderBy("n", "role", "content")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumns(
        {
            "last": F.lag(message).over(order),
            "no_role": F.coalesce(F.max(no_role).over(before), F.lit(False)),
            "no_content": F.coalesce(F.max(no_content).over(before), F.lit(False)),
            "start": F.coalesce(F.sum("words").over(before), F.lit(0).cast("bigint")),
        }
    )
    ends = dealt.groupBy("segment", "c").agg(
        F.max(F.struct("n", "role", "content")).alias("end"),
        F.max(no_role).alias("any_no_role"),
        F.max(no_content).alias("any_no_content"),
        F.sum("words").alias("words"),
    )
    # a conversation has at most one row per segment here
    onward = Window.partitionBy("c").orderBy("segment")
    earlier = onward.rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        F.col("segment").alias("_segment"),
        F.col("c").alias("_c"),
        F.lag(F.struct("end.role", "end.content")).over(onward).alias("_last"),
        F.max("any_no_role").over(earlier).alias("_no_role"),
        F.max("any_no_content").over(earlier).alias("_no_content"),
        F.sum("words").over(earlier).alias("_start"),
    ).filter(F.col("_last").isNotNull())
    same = (F.col("segment") == F.col("_segment")) & F.col("c").eqNullSafe(F.col("_c"))
    if window_words:
        placed = inside.join(carried, same, "left").withColumn("start", F.col("start") + F.coalesce("_start", F.lit(0)))
        asked = _with_window(materialize(placed, "placed-turns"), asker, window_words)
    else:
        asked = inside.filter(F.col("role") == asker).join(carried, same, "left")
    return asked.select(
        F.concat_ws("-", "c", "n").alias("request_id"),
        F.col("content").alias("question"),
        F.coalesce("last", "_last").alias("last_message"),
        (F.col("no_role") | F.coalesce("_no_role", F.lit(False))).alias("missing_role"),
        (F.col("no_content") | F.coalesce("_no_content", F.lit(False))).alias("missing_content"),
        *[F.col("history")] * bool(window_words),
    )


def _with_window(placed: DataFrame, asker: str, window: int) -> DataFrame:
    """The asker's turns with ``history``, the messages whose words end within the window before them.

    A stretch of ``window`` words of a conversation is a group; a question meets its own and the one before. Messages have a
    word at least, so a group has at most ``window`` of them, however long the conversation is.
    """
    asked = placed.filter(F.col("role") == asker)
    stretch = F.floor(F.col("start") / window)
    ends = F.col("start") + F.col("words")
    messages = placed.select(
        F.col("c").alias("_c"),
        F.floor(ends / window).alias("_stretch"),
        F.struct(F.col("start").alias("at"), "role", "content").alias("_message"),
        ends.alias("_ends"),
    )
    met = asked.select("c", "start", F.explode(F.array(stretch, stretch - 1)).alias("_stretch"))
    near = met.join(messages, F.col("c").eqNullSafe(F.col("_c")) & (met["_stretch"] == messages["_stretch"]))
    near = near.filter((F.col("_ends") <= F.col("start")) & ((F.col("_message.at") >= F.col("start") - window) | (F.col("_ends") == F.col("start"))))
    histories = near.groupBy(F.col("c").alias("_hc"), F.col("start").alias("_hs")).agg(F.array_sort(F.collect_list("_message")).alias("_messages"))
    own = F.col("c").eqNullSafe(F.col("_hc")) & (F.col("start") == F.col("_hs"))
    history = F.transform(F.coalesce("_messages", F.array()), lambda m: F.struct(m["role"], m["content"])).cast(MESSAGES)
    return asked.join(histories, own, "left").withColumn("history", history)


def question_problem() -> Column:
    """``request_problem`` of the rows of ``questions_from_turns``."""
    return F.when(F.col("missing_role"), "missing_role").when(
        F.col("missing_content") | F.col("question").isNull(), "missing_content"
    )


def history_problem() -> Column:
    """``request_problem`` of the messages before the question, for the rows of ``questions_from_turns``."""
    return (
        F.when(F.col("last_message").isNull(), "empty_messages")
        .when(F.col("missing_role"), "missing_role")
        .when(F.col("missing_content"), "missing_content")
    )


def extract_question(messages: Column) -> Column:
    """Content of the last message, whatever its role; null for an empty list."""
    return F.try_element_at(messages, F.lit(-1))["content"]


def extract_history(messages: Column) -> Column:
    """All messages but the last."""
    return F.slice(messages, F.lit(1), F.greatest(F.size(messages) - 1, F.lit(0)))


def check_request_schema(df: DataFrame, column: str = "messages") -> None:
    """Refuse a table whose messages are not a list of ``{role, content}`` strings."""
    if column not in df.columns:
        raise ValueError(f"requests need a column {column!r}")
    found = df.schema[column].dataType
    if not isinstance(found, T.ArrayType) or not isinstance(found.elementType, T.StructType):
        raise ValueError(f"{column!r} must be an array of structs, not {found.simpleString()}")
    fields = {f.name: f.dataType for f in found.elementType.fields}
    if fields != {f.name: f.dataType for f in MESSAGE.fields}:
        raise ValueError(f"{column!r} must hold {MESSAGE.simpleString()}, not {found.elementType.simpleString()}")


def request_problem(messages: Column) -> Column:
    """Why a request cannot be answered, or null."""
    return (
        F.when(messages.isNull() | (F.size(messages) == 0), "empty_messages")
        .when(F.exists(messages, lambda m: m.isNull() | m["role"].isNull()), "missing_role")
        .when(F.exists(messages, lambda m: m["content"].isNull()), "missing_content")
        .otherwise(F.lit(None).cast("string"))
    )


def validate_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into answerable requests and rejects with a ``reason``."""
    check_request_schema(requests)
    judged = requests.withColumn("reason", request_problem(F.col("messages")))
    good = judged.filter(F.col("reason").isNull()).drop("reason")
    return good, judged.filter(F.col("reason").isNotNull())


def split_messages(requests: DataFrame) -> DataFrame:
    """Replace ``messages`` by ``question`` and ``history``."""
    return requests.withColumn("question", extract_question(F.col("messages"))).withColumn(
        "history", extract_history(F.col("messages"))
    ).drop("messages")


def route(verdict: Column) -> Column:
    """``answer`` if the verdict contains yes, in any case; else ``refuse``.

    Yes is looked for first, so a verdict with both words is answered.
    """
    return F.when(F.contains(F.lower(verdict), F.lit("yes")), "answer").otherwise("refuse")


def refusals(requests: DataFrame, topic: str) -> DataFrame:
    """Fixed answer without sources for each request."""
    return requests.select(
        "request_id",
        prompts.render(prompts.REFUSAL, topic=topic).alias("result"),
        F.array().cast("array<string>").alias("sources"),
    )


def with_history_text(requests: DataFrame) -> Column:
    """The messages' contents before the question and the question, in order, as one text."""
    return F.concat_ws(" ", F.transform("history", lambda m: m["content"]), F.col("question"))


def last_message(requests: DataFrame) -> Column:
    """The message before the question, from the history or as ``questions_from_turns`` gives it; null if there is none."""
    if "history" in requests.columns:
        return F.try_element_at("history", F.lit(-1))
    return F.col("last_message")


def has_history(requests: DataFrame) -> Column:
    if "history" in requests.columns:
        return F.size("history") > 0
    return F.col("last_message").isNotNull()


def question_with_last_message(question: Column, last: Column) -> Column:
    """Offline stand-in for a rewriting model: the question and the message before it."""
    return F.concat_ws(" ", question, last["content"])


def search_query(question: Column, history: Column, rewritten: Column) -> Column:
    """The rewritten query where there is a history, else the question itself."""
    return F.when(F.size(history) > 0, rewritten).otherwise(question)


def gather_documents(matches: DataFrame, key: str = "request_id") -> DataFrame:
    """Context block and source list per request, in rank order.

    A request has at most k matches. Urls repeat when several of its chunks won.
    """
    docs = F.array_sort(F.collect_list(F.struct("rank", "content", "url")))
    return matches.groupBy(key).agg(docs.alias("_docs")).select(
        key,
        F.array_join(F.transform("_docs", lambda d: d["content"]), "\n\n").alias("context"),
        F.transform("_docs", lambda d: d["url"]).alias("sources"),
        F.get("_docs", F.lit(0))["content"].alias("top_content"),
    )
