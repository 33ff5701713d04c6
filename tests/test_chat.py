"""Conversations, prompts, routing and the answer flow."""

import json

import pytest
from pyspark.sql import functions as F

from askquarry.functions import prompts
from askquarry.functions.hashing import hash_embed
from askquarry.operators import chat
from askquarry.operators.records import vector_records
from askquarry.plans import answers, standins

REQUEST = "request_id string, messages array<struct<role:string,content:string>>"
# Shapes of requests: no history, a follow-up, a longer dialogue, one ending with the assistant.
ONE = [("user", "How much is Parking charged?")]
THREE = [("user", "Which bus goes to the harbour?"), ("assistant", "Line nine."), ("user", "Does it run at night?")]
FIVE = THREE + [("assistant", "Yes."), ("user", "And what comes after that?")]
ENDS_WITH_ASSISTANT = THREE[:2]


def requests(spark, *messages):
    return spark.createDataFrame([(f"r{i}", m) for i, m in enumerate(messages)], REQUEST)


def test_question_and_history(spark):
    rows = chat.split_messages(requests(spark, ONE, THREE, FIVE, ENDS_WITH_ASSISTANT)).orderBy("request_id").collect()
    assert [r["question"] for r in rows] == [m[-1][1] for m in (ONE, THREE, FIVE, ENDS_WITH_ASSISTANT)]
    assert [len(r["history"]) for r in rows] == [0, 2, 4, 1]


def test_validation(spark):
    good, bad = chat.validate_requests(requests(spark, ONE, [], None, [("user", None)], [(None, "x")]))
    assert [r["request_id"] for r in good.collect()] == ["r0"]
    assert {(r["request_id"], r["reason"]) for r in bad.collect()} == {
        ("r1", "empty_messages"),
        ("r2", "empty_messages"),
        ("r3", "missing_content"),
        ("r4", "missing_role"),
    }


@pytest.mark.parametrize("schema", ["q string", "messages string", "messages array<struct<role:string,text:string>>"])
def test_wrong_request_schema_is_refused(spark, schema):
    with pytest.raises(ValueError):
        chat.check_request_schema(spark.createDataFrame([], schema))


@pytest.mark.parametrize(
    "verdict, goes", [("Yes.", "answer"), ("NO", "refuse"), ("yes and no", "answer"), ("unsure", "refuse"), (None, "refuse")]
)
def test_routing(spark, verdict, goes):
    row = spark.createDataFrame([(verdict,)], "v string").select(chat.route(F.col("v")).alias("r")).first()
    assert row["r"] == goes


def test_slots_fill_once(spark):
    df = spark.createDataFrame([("{question} %s {chat_history}", "x")], "q string, h string")
    text = prompts.render("A {chat_history} B {question}!", question=F.col("q"), chat_history=F.col("h"))
    assert df.select(text.alias("t")).first()["t"] == "A x B {question} %s {chat_history}!"
    with pytest.raises(KeyError):
        prompts.render(prompts.WITH_CONTEXT, question=F.col("q"))


def test_every_template_has_its_slots():
    assert prompts.slots(prompts.PLAIN) == ["question"]
    assert set(prompts.slots(prompts.WITH_HISTORY)) == {"chat_history", "question"}
    assert set(prompts.slots(prompts.RELEVANCE)) == {"topic", "chat_history", "question"}
    assert set(prompts.slots(prompts.SEARCH_QUERY)) == {"chat_history", "question"}
    assert set(prompts.slots(prompts.WITH_CONTEXT)) == {"chat_history", "context", "question"}


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_requests_from_turns(spark):
    rows = turns(spark, [(1, 2, "user", "c"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "assistant", "z")])
    got = {r["request_id"]: [tuple(m) for m in r["messages"]] for r in chat.requests_from_turns(rows).collect()}
    assert got == {
        "1-0": [("user", "a")],
        "1-2": [("user", "a"), ("assistant", "b"), ("user", "c")],
    }


def test_hot_conversation_is_split_without_loss(spark):
    """One conversation holds most turns, with gaps in its numbering."""
    rows = [(1, 3 * t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(50)]
    rows += [(c, t, "user", "x") for c in range(2, 6) for t in range(3)]
    df = turns(spark, rows)
    kept = chat.assemble_messages(df, max_messages=20).collect()
    late = chat.late_turns(df, max_messages=20).collect()
    assert {r["conv_id"]: len(r["messages"]) for r in kept} == {1: 20, 2: 3, 3: 3, 4: 3, 5: 3}
    assert sorted(r["turn"] for r in late) == [3 * t for t in range(20, 50)]
    assert sum(len(r["messages"]) for r in kept) + len(late) == len(rows)


def test_every_user_turn_of_a_long_conversation_is_a_request(spark):
    rows = [(1, t, "user", f"q{t}") for t in range(2500)]
    assert chat.requests_from_turns(turns(spark, rows)).select("request_id").distinct().count() == 2500


def test_questions_equal_those_of_the_whole_messages(spark):
    """One conversation of 2,500 turns over many segments; gaps, ties, nulls and a null conversation."""
    rows = [(1, 3 * t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(2500)]
    rows += [(2, 0, "assistant", "z"), (2, 1, None, "a"), (2, 2, "user", "b"), (3, 0, "user", None), (3, 1, "user", "c")]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", None), (None, 1, "user", "y"), (None, 1, "user", "y")]
    df = turns(spark, rows[::-1])
    whole = chat.split_messages(chat.requests_from_turns(df).withColumn("problem", chat.request_problem(F.col("messages"))))
    whole = whole.withColumns({"last": F.try_element_at("history", F.lit(-1)), "earlier": chat.request_problem(F.col("history"))})
    slim = chat.questions_from_turns(df).withColumns({"problem": chat.question_problem(), "earlier": chat.history_problem()})
    slim = slim.withColumnRenamed("last_message", "last")
    expected, got = (
        sorted(repr(tuple(r)) for r in x.select("request_id", "question", "last", "problem", "earlier").collect())
        for x in (whole, slim)
    )
    assert got == expected and len(got) == 1256


def test_a_long_conversation_is_not_one_task_and_has_no_prefixes(spark):
    df = turns(spark, [(1, t, "user", f"q{t}") for t in range(2500)])
    asked = chat.questions_from_turns(df)
    assert "array" not in asked.schema.simpleString()
    dealt = chat._segments(df.toDF("c", "n", "role", "content")).groupBy("segment").count().collect()
    assert max(r["count"] for r in dealt) < 1250 and asked.count() == 2500
    plan = answers.AnswerPlan(judge=word_judge, topic="buses")
    queries = {r["request_id"]: r["query"] for r in answers.rewrite_queries(asked, plan).collect()}
    assert queries["1-0"] == "q0" and queries["1-2499"] == "q2499 q2498" and len(queries) == 2500


def test_tied_turns_are_kept_or_late(spark):
    df = turns(spark, [(1, t, "user", f"q{k}") for k, t in enumerate([0, 1, 1, 1])])
    kept = chat.assemble_messages(df, max_messages=2).first()["messages"]
    late = chat.late_turns(df, max_messages=2).collect()
    assert sorted([m["content"] for m in kept] + [r["text"] for r in late]) == ["q0", "q1", "q2", "q3"]


def test_documents_in_rank_order_with_repeated_urls(spark):
    rows = spark.createDataFrame(
        [("r", 2, "second", "u"), ("r", 1, "first", "u"), ("r", 3, "third", "v")],
        "request_id string, rank int, content string, url string",
    )
    row = chat.gather_documents(rows).first()
    assert row["context"] == "first\n\nsecond\n\nthird" and row["sources"] == ["u", "u", "v"]


def corpus(spark):
    texts = [
        ("1", "docs/a", "Buses run at night too. Tickets cost more."),
        ("2", "docs/b", "Parking is charged hourly. See the price list."),
        ("3", "docs/a", "At night it run slowly."),
    ]
    return vector_records(hash_embed(spark.createDataFrame(texts, "id string, url string, content string"), "content"), "n")


def word_judge(df):
    hits = F.contains(F.lower("question"), F.lit("night")) | F.contains(F.lower("question"), F.lit("parking"))
    return df.withColumn("verdict", F.when(hits, "yes").otherwise("no"))


def test_answer_flow(spark):
    sky = THREE[:2] + [("user", "Who painted the old mill?")]
    plan = answers.AnswerPlan(judge=word_judge, topic="buses", k=2)
    rows = answers.answer_requests(requests(spark, ONE, THREE, sky), corpus(spark), plan)
    assert rows.select("result", "sources").schema.simpleString() == chat.ANSWER.simpleString()
    got = {r["request_id"]: (r["result"], r["sources"]) for r in rows.collect()}
    assert got["r2"] == ("I can only answer questions about buses.", [])
    assert len(got["r0"][1]) == 2 and got["r1"][1].count("docs/a") == 2


def recording_model(log):
    """A model plug-in that writes each prompt it is sent to a file."""

    def factory():
        def call(batch, max_tokens):
            with open(log, "a") as out:
                out.writelines(json.dumps(p) + "\n" for p in batch)
            return [f"answer {len(p)}" for p in batch]

        return call

    return factory


def test_model_stages_see_only_the_rows_they_need(spark, tmp_path):
    logs = {name: str(tmp_path / name) for name in ("judge", "rewrite", "answer")}
    for log in logs.values():
        open(log, "w").close()
    sky = [("user", "Who painted the old mill?")]

    def judge(df):
        seen = answers.model_stage(recording_model(logs["judge"]), prompts.RELEVANCE, "_ignored", {"topic": "buses"})
        return word_judge(seen(df)).drop("_ignored")

    plan = answers.AnswerPlan(
        judge=judge,
        topic="buses",
        rewrite=answers.model_stage(recording_model(logs["rewrite"]), prompts.SEARCH_QUERY, "query"),
        answer=answers.model_stage(recording_model(logs["answer"]), prompts.WITH_CONTEXT, "answer"),
    )
    told = answers.answer_requests(requests(spark, ONE, THREE, sky), corpus(spark), plan)
    assert told.count() == 3 and told.count() == 3
    calls = {name: [json.loads(line) for line in open(log)] for name, log in logs.items()}
    assert len(calls["judge"]) == 3  # once each, though two branches read the verdict
    assert len(calls["rewrite"]) == 1 and "night" in calls["rewrite"][0]  # only with a history
    assert len(calls["answer"]) == 2  # never for a refused request


def test_context_limit_drops_the_lowest_ranks(spark):
    wide, narrow = (
        answers.answer_relevant(
            chat.split_messages(requests(spark, THREE)),
            corpus(spark),
            answers.AnswerPlan(judge=word_judge, topic="buses", context_words=limit),
        ).first()["sources"]
        for limit in (100, 13)
    )
    assert len(wide) == 3 and narrow == wide[:2]


def test_empty_corpus_still_answers(spark):
    plan = answers.AnswerPlan(judge=word_judge, topic="buses")
    rows = answers.answer_requests(requests(spark, ONE), corpus(spark).filter("id = 'none'"), plan).collect()
    assert [(r["result"], r["sources"]) for r in rows] == [("", [])]


def test_windows_of_a_long_conversation_equal_the_rule(spark):
    """One conversation of 2,000 turns, tied and empty ones among them; a null conversation; a message longer than the window."""
    rows = [(1, t // 2 if t % 50 == 0 else t, "user" if t % 3 else "assistant", "w " * (t % 7) + f"t{t}") for t in range(2000)]
    rows += [(2, 0, "user", "long " * 90), (2, 1, "user", "after"), (2, 2, None, ""), (2, 3, "user", None), (2, 4, "user", "last")]
    rows += [(None, 0, "assistant", "x"), (None, 1, "user", "y")]
    window, want = 40, []
    for conv in (1, 2, None):
        messages = sorted((r[1:] for r in rows if r[0] == conv), key=lambda m: (m[0], m[1] is not None, m[1] or "", m[2] is not None, m[2] or ""))
        for k, (turn, role, content) in enumerate(messages):
            if role != "user":
                continue
            kept, size = [], 0
            for _, r, c in messages[:k][::-1]:
                size += max(1, len((c or "").split()))
                if kept and size > window:
                    break
                kept.insert(0, (r, c))
            want.append(("" if conv is None else f"{conv}-", turn, content, kept))
    want = sorted(repr((f"{c}{t}", q, h)) for c, t, q, h in want)
    found = chat.questions_from_turns(turns(spark, rows[::-1]), window_words=window)
    got = [repr((r["request_id"], r["question"], [tuple(m) for m in r["history"]])) for r in found.collect()]
    assert sorted(got) == want
    slim = chat.questions_from_turns(turns(spark, rows))
    assert found.drop("history").exceptAll(slim).count() == 0 == slim.exceptAll(found.drop("history")).count()


def test_ten_thousand_turns_in_one_conversation(spark):
    found = chat.questions_from_turns(turns(spark, [(1, t, "user", "some words here") for t in range(10_000)]), window_words=30)
    row = found.agg(F.count("*").alias("n"), F.max(F.size("history")).alias("most"), F.sum(F.size("history")).alias("all")).first()
    assert (row["n"], row["most"], row["all"]) == (10_000, 10, 10 * 10_000 - 55)


def reading_plan(**options):
    reader = answers.model_stage(standins.reading_model, prompts.WITH_CONTEXT, "answer")
    return answers.AnswerPlan(judge=word_judge, topic="buses", answer=reader, **options)


def test_the_whole_context_can_change_the_answer(spark):
    asked = chat.split_messages(requests(spark, [("user", "Buses run at night but what does the price list say")]))
    (told,) = answers.answer_relevant(asked, corpus(spark), reading_plan()).collect()
    assert told["result"] == "Buses run at night too."
    changed = corpus(spark).withColumn("metadata", F.replace("metadata", F.lit("See the price list"), F.lit("what does the price list say at night")))
    (other,) = answers.answer_relevant(asked, changed, reading_plan()).collect()
    assert other["sources"] == told["sources"] and other["result"].startswith("what does the price list say")
    (unknown,) = answers.answer_relevant(asked, corpus(spark).limit(0), reading_plan()).collect()
    assert unknown["result"] == "I do not know."


def test_rejects_come_back_with_their_reason(spark):
    sent = requests(spark, ONE, [], [("user", None)], [("user", "Who painted the old mill?")])
    told = {r["request_id"]: (r["result"], r["sources"], r["reason"]) for r in answers.answer_all(sent, corpus(spark), reading_plan(k=1)).collect()}
    assert told["r0"][0] and told["r0"][1:] == (["docs/b"], None)
    assert told["r1"] == (None, [], "empty_messages") and told["r2"] == (None, [], "missing_content")
    assert told["r3"] == ("I can only answer questions about buses.", [], None)
    rows = chat.questions_from_turns(turns(spark, [(1, 0, "user", "Parking?"), (1, 1, None, "x"), (1, 2, "user", "y")]), window_words=9)
    told = {r["request_id"]: r["reason"] for r in answers.answer_all(rows, corpus(spark), reading_plan()).collect()}
    assert told == {"1-0": None, "1-2": "missing_role"}


def test_a_follow_up_is_judged_with_the_earlier_turns(spark):
    from askquarry.operators import classify

    kinds = spark.createDataFrame([("buses", "bus night harbour"), ("mills", "mill painted old")], "label string, text string")
    centroids = classify.class_centroids(hash_embed(kinds, "text", "values"), "label", "values")
    both = [[("user", "the old mill painted"), ("user", "and then")], [("user", "the night bus"), ("user", "and then")]]
    split = chat.split_messages(requests(spark, *both))
    judged = classify.nearest_class(hash_embed(split.withColumn("t", chat.with_history_text(split)), "t", "v"), centroids, "v")
    assert [r["predicted"] for r in judged.orderBy("request_id").collect()] == ["mills", "buses"]


def test_the_registered_model_stage_is_sent_and_writes_no_documents_beside_the_prompt(spark, sf_dir):
    from workload.queries import plan

    message = "array<struct<role: string, content: string>>"
    ready = spark.createDataFrame(
        [("r", "Where is it?", [("user", "Hello.")], "It is here. It was there.", ["u"], "It is here.")],
        f"request_id string, question string, history {message}, context string, sources array<string>, top_content string",
    )
    told = plan(spark, sf_dir).answer(ready)
    assert told.columns == ["request_id", "sources", "answer"]
    assert [tuple(r) for r in told.collect()] == [("r", ["u"], "It is here.")]
