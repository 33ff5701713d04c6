"""License scan by diagonal voting (operator 3). DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from askquarry.llm.common import ascii_lower, text_key

# The phrases of the base labels.
PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
# Paragraphs of public licenses, lower case and without punctuation.
PARAGRAPHS = [
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("apache", "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and distribute the work and such derivative works in source or object form"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "you must give appropriate credit provide a link to the license and indicate if changes were made you may do so in any reasonable manner but not in any way that suggests the licensor endorses you or your use"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program if not see"),
    ("gpl", "the licenses for most software and other practical works are designed to take away your freedom to share and change the works by contrast the gnu general public license is intended to guarantee your freedom to share and change all versions of a program to make sure it remains free software for all its users"),
    ("gpl", "when we speak of free software we are referring to freedom not price our general public licenses are designed to make sure that you have the freedom to distribute copies of free software and charge for them if you wish that you receive source code or can get it if you want it that you can change the software or use pieces of it in new free programs and that you know you can do these things"),
    ("gpl", "you may convey verbatim copies of the program s source code as you receive it in any medium provided that you conspicuously and appropriately publish on each copy an appropriate copyright notice keep intact all notices stating that this license and any non permissive terms added in accord with section 7 apply to the code"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
]
#: Pairs of two such words are no evidence for a template; phrases use all their pairs.
COMMON = "a an and any are as at be by for from in is it not of on or that the this to was with you".split()
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Diagonals so near are one copy with words added or left out.
NEAR_DIAGONALS = 3
#: Share of a template's pairs that a copy must hold, and the most words it may span per template word.
COVERED, STRETCH = 0.6, 2
SLOTS = 16384
#: The most words of a template; their pairs are the bits of a long.
TEMPLATE_WORDS = 40


def templates(paragraphs: list[tuple[str, str]], most: int = TEMPLATE_WORDS) -> list[tuple[str, str]]:
    """Paragraphs cut into parts of about equal length, of ``most`` words at most; each is a template of its own."""
    parts = []
    for label, text in paragraphs:
        words = text.split()
        n = -(-len(words) // most)
        parts += [(label, " ".join(words[len(words) * k // n : len(words) * (k + 1) // n])) for k in range(n)]
    return parts


def template_grams(spark: SparkSession) -> DataFrame:
    """(h, a, b, template, at, bit, label, phrase, words, full): one row per two-word gram of every template.

    ``full`` has a bit for each gram that counts.
    """
    rows = []
    for number, (label, text) in enumerate(PHRASES + templates(PARAGRAPHS)):
        phrase, words = number < len(PHRASES), text.split()
        pairs = [(k, a, b) for k, (a, b) in enumerate(zip(words, words[1:], strict=False)) if phrase or not (a in COMMON and b in COMMON)]
        full = sum(1 << k for k, _, _ in pairs)
        rows += [(a, b, number, k, 1 << k, label, phrase, len(words), full) for k, a, b in pairs]
    grams = spark.createDataFrame(rows, "a string, b string, template int, at int, bit long, label string, phrase boolean, words int, full long")
    return grams.withColumn("h", F.xxhash64("a", "b"))


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Every two-word gram's hash is joined to the template positions with that hash, and the words compared. A
    hit votes for its diagonal, the word where the template would start. A phrase stands where
    a diagonal has all its grams. Templates may be damaged: neighbouring diagonals are merged, and the span is accepted
    when it holds enough of the grams within a bounded length. score is the largest covered share, 1 for a phrase.

    Votes are bits, so copies of a text vote once and partial aggregation shrinks them; texts meet their
    results by key. A table of slots passes on only grams that share a slot with a template's. Null counts as empty;
    rows without words or hits have 0, null or empty values, repeated rows equal ones. Texts of any length are
    read whole; an empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    grams = template_grams(spark)
    taken = {r["h"] % SLOTS for r in grams.select("h").collect()}
    slots = F.split(F.lit(",".join(str(k in taken) for k in range(SLOTS))), ",").cast("array<boolean>")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(ascii_lower(text), NOT_WORD), lambda w: w != "")
    texts = docs.select(*text_key(text), words.alias("w"))
    at = F.when(F.size("w") > 1, F.sequence(F.lit(0), F.size("w") - 2)).otherwise(F.array().cast("array<int>"))
    hashed = F.transform(at, lambda i: F.struct(i.alias("i"), F.xxhash64(F.get("w", i), F.get("w", i + 1)).alias("h")))
    near = F.filter(hashed, lambda s: F.get(slots, F.pmod(s["h"], F.lit(SLOTS)).cast("int")))
    near = F.transform(near, lambda s: F.struct(s["i"].alias("i"), s["h"].alias("h"), F.get("w", s["i"]).alias("a"), F.get("w", s["i"] + 1).alias("b")))
    hits = texts.select("k1", "k2", F.explode(near).alias("s")).select("k1", "k2", "s.*")
    # the templates are a fixed list of some 900 grams
    hits = hits.join(F.broadcast(grams), ["h", "a", "b"])
    by = ["k1", "k2", "template", "label", "phrase", "words", "full"]
    votes = hits.groupBy(*by, (F.col("i") - F.col("at")).alias("diagonal")).agg(F.bit_or("bit").alias("mask"))

    run = Window.partitionBy("k1", "k2", "template").orderBy("diagonal")
    apart = F.col("phrase") | (F.col("diagonal") - F.lag("diagonal").over(run) > NEAR_DIAGONALS)
    copies = votes.withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("copy", F.sum("apart").over(run))
    last = F.col("diagonal") + F.length(F.bin("mask"))
    spans = copies.groupBy(*by, "copy").agg(F.bit_or("mask").alias("mask"), F.min("diagonal").alias("start"), F.max(last).alias("end"))
    share = F.bit_count("mask") / F.bit_count("full")
    whole = F.when(F.col("phrase"), share == 1).otherwise((share >= COVERED) & (F.col("end") - F.col("start") <= STRETCH * F.col("words")))
    spans = spans.withColumn("share", share).where(whole)

    def labels(only: str) -> Column:
        return F.array_join(F.sort_array(F.collect_set(F.when(F.expr(only), F.col("label")))), ",")

    base = F.when(F.col("phrase"), F.col("start"))
    found = spans.groupBy("k1", "k2").agg(
        F.count(base).alias("n_base"), F.min(base).cast("long").alias("first_word"), F.max(base).cast("long").alias("last_word"),
        labels("phrase").alias("base_labels"), labels("true").alias("labels"), F.max("share").alias("score"),
    )
    rows = docs.select("doc_id", *text_key(text), F.size(words).cast("long").alias("n_words")).join(found, ["k1", "k2"], "left")
    empty = {"n_base": 0, "base_labels": "", "labels": "", "score": 0.0}
    return rows.fillna(empty).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
