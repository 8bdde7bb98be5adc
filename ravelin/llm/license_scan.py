"""License scans with a positional rare-token index, in DataFrame functions only.

1. One pass over the texts keeps, per row, the places of licence words: the compared words of all
   templates and the words of the base phrases.
2. Their document frequencies over all rows give the IDF. The index word -> (template, place in it)
   holds each template's ``RARE`` mandatory words of highest IDF, so what a file looks up are the
   rarest licence words that can decide.
3. Postings are intersected by relative position: a file and template become a candidate in a window
   of shifts in which all of the template's indexed words stand. A label needs all its mandatory words,
   so none is lost.
4. A candidate's compared words are then looked up in the same window, by one join on (row, template,
   window). It is a label if each mandatory key phrase stands whole at one shift of the window, and at
   least ``LEAST`` of the compared words stand somewhere in it.

Notices of one line stand at one shift (a window of 1). Whole notices may lose or gain words, list
numbers for instance, so their windows are ``DRIFT`` shifts wide and overlap by half.

Base phrases are found from the same places, wherever their words stand next to each other; each place
is compared with those next to it only, so the work is in proportion to the text.

Defined cases: null text counts as empty: no words, no labels, null first and last word, score 0;
a very long text, also one of a phrase over and over, is one row of places and its postings are dealt by
(row, template, window); equal rows give equal rows; a null doc_id stays null; an empty table gives no
rows; other columns are not read. Templates tie freely: each found label is listed. The score is the
largest share of a found template's compared words that stand, 0 without a template.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ravelin.llm.common import materialize

#: Indexed words of a template; a template of fewer mandatory words has them all in the index.
RARE = 2
LEAST = 0.8
#: Shifts that a whole notice may run over; its words of fewer letters are compared in key phrases only.
DRIFT, LETTERS = 8, 5

#: Phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices of one line: label, words (``_`` is any word), mandatory key phrases.
LINES = [
    ("agpl-3.0", "gnu affero general public license version 3", ["affero general public license", "version 3"]),
    ("apache-2.0", "licensed _ _ apache license version 2 0", ["apache license version 2 0"]),
    ("bsd", "redistribution _ use _ source _ binary forms", ["redistribution", "source", "binary forms"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("gpl-2.0", "gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-3.0", "gnu general public license version 3", ["gnu general public license version 3"]),
    ("lgpl", "gnu lesser general public license", ["gnu lesser general public license"]),
    ("mit", "released under _ mit license", ["mit license"]),
    ("mpl-2.0", "mozilla public license version 2 0", ["mozilla public license"]),
    ("unlicense", "free _ unencumbered software released", ["unencumbered software"]),
]
#: Whole notices: label, text, mandatory key phrases.
NOTICES = [
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        ["hereby granted free", "copy modify merge publish distribute sublicense", "substantial portions"],
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
        ["hereby granted provided", "permission notice appear"],
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
        ["permitted provided", "must retain", "must reproduce"],
    ),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at",
        ["apache license version 2 0", "file except"],
    ),
    (
        "gpl-2.0",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
        ["gnu general public license", "free software foundation either version 2"],
    ),
    (
        "gpl-3.0",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
        ["gnu general public license", "free software foundation either version 3"],
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at",
        ["source code form", "mozilla public license"],
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
        ["unencumbered software released", "public domain anyone"],
    ),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What no word has, and what words are made of.
BREAK, WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"


@dataclass(frozen=True)
class Template:
    label: str
    #: Compared words by their place.
    words: tuple[tuple[int, str], ...]
    #: Places of each mandatory phrase.
    phrases: tuple[tuple[int, ...], ...]
    drift: int

    @property
    def must(self) -> set[int]:
        return {p for phrase in self.phrases for p in phrase}

    @property
    def step(self) -> int:
        return max(1, self.drift // 2)


def template(label: str, text: str, phrases: list[str], drift: int) -> Template:
    words, places = text.split(), []
    for phrase in phrases:
        p = phrase.split()
        at = next(i for i in range(len(words)) if words[i : i + len(p)] == p)
        places.append(tuple(range(at, at + len(p))))
    must = {i for p in places for i in p}
    compared = tuple((i, w) for i, w in enumerate(words) if w != "_" and (i in must or drift == 1 or len(w) >= LETTERS))
    return Template(label, compared, tuple(places), drift)


TEMPLATES = [template(*t, 1) for t in LINES] + [template(*t, DRIFT) for t in NOTICES]
VOCABULARY = sorted({w for t in TEMPLATES for _, w in t.words} | {w for p in BASE for w in p.split()})


def licence_places(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words and the places (p, w) of licence words in it; w counts in ``VOCABULARY``."""
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    words = F.filter(F.split(text, f"{BREAK}+"), lambda w: w != "")
    split = documents.select(F.col("doc_id").cast("long"), words.alias("words"))
    held = F.filter(F.transform("words", lambda w, i: F.struct(i.cast("int").alias("p"), w.alias("w"))), lambda x: x["w"].isin(VOCABULARY))
    return split.select("doc_id", F.size("words").cast("long").alias("n_words"), held.alias("places"))


def base_starts(phrase: str) -> Column:
    """First places of a phrase in ``places``, whose neighbours in it are compared only."""
    words = phrase.split()

    def begins(x: Column, i: Column) -> Column:
        found = x["w"] == words[0]
        for step, word in enumerate(words[1:], 1):
            y = F.get("places", i + step)
            found = found & F.coalesce((y["w"] == word) & (y["p"] == x["p"] + step), F.lit(False))
        return found

    return F.transform(F.filter("places", begins), lambda x: x["p"])


def windows(shift: Column, drift: Column) -> Column:
    """The windows that hold a shift: itself, or the two of ``drift`` shifts that overlap by half."""
    half = F.floor(shift / F.greatest(F.lit(1), F.floor(drift / 2))).cast("int")
    return F.when(drift == 1, F.array(half)).otherwise(F.array(half, half - 1))


def own_labels(found: DataFrame, counts: dict[str, int]) -> DataFrame:
    """(row, own, score) of the rows that match a template; ``counts`` are document frequencies."""
    spark = found.sparkSession
    index, pattern, phrases = [], [], []
    for n, t in enumerate(TEMPLATES):
        rare = sorted((counts.get(w, 0), i, w) for i, w in t.words if i in t.must)[:RARE]
        index += [(w, n, i, t.drift, len(rare)) for _, i, w in rare]
        pattern += [(w, n, i, t.drift) for i, w in t.words]
        phrases.append((n, t.label, len(t.words), [list(p) for p in t.phrases]))
    index = spark.createDataFrame(index, "w string, template int, place int, drift int, least int")
    pattern = spark.createDataFrame(pattern, "w string, template int, place int, drift int")
    phrases = spark.createDataFrame(phrases, "template int, label string, size int, phrases array<array<int>>")
    dealt = lambda rows: rows.withColumn("shift", F.col("p") - F.col("place")).withColumn("window", F.explode(windows(F.col("shift"), F.col("drift"))))

    rare = [r["w"] for r in index.select("w").distinct().collect()]  # at most RARE for each template
    looked_up = found.select("row", F.explode(F.filter("places", lambda x: x["w"].isin(rare))).alias("x")).select("row", "x.p", "x.w")
    agreeing = dealt(looked_up.join(F.broadcast(index), "w")).groupBy("row", "template", "window", "least").agg(F.count_distinct("place").alias("n"))
    candidates = materialize(agreeing.where(F.col("n") == F.col("least")).select("row", "template", "window"), "licence-candidates")

    asked = found.join(candidates.select("row").distinct(), "row", "left_semi").select("row", F.explode("places").alias("x")).select("row", "x.p", "x.w")
    postings = dealt(asked.join(F.broadcast(pattern), "w")).join(candidates, ["row", "template", "window"], "left_semi")
    at_shift = postings.groupBy("row", "template", "window", "shift").agg(F.collect_set("place").alias("places"))  # at most a template's words
    told = at_shift.join(F.broadcast(phrases), "template").withColumn("whole", F.filter("phrases", lambda p: F.size(F.array_except(p, F.col("places"))) == 0))
    of = told.groupBy("row", "template", "label", "window", "size").agg(F.flatten(F.collect_set("places")).alias("places"), F.flatten(F.collect_set("whole")).alias("whole"), F.first("phrases").alias("phrases"))
    share = F.size(F.array_distinct("places")) / F.col("size")
    good = of.withColumn("share", share).where((F.size(F.array_except("phrases", "whole")) == 0) & (F.col("share") >= LEAST))
    return good.groupBy("row").agg(F.collect_set("label").alias("own"), F.max("share").alias("score"))


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per row."""
    rows = materialize(licence_places(documents).withColumn("row", F.monotonically_increasing_id()), "licence-places")
    found = rows.where(F.size("places") > 0)
    df = found.select(F.explode(F.array_distinct(F.transform("places", lambda x: x["w"]))).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()  # at most the vocabulary
    own = own_labels(found, {r["w"]: r["n"] for r in df})

    starts = rows.select("row", "doc_id", "n_words", *(base_starts(p).alias(f"s{i}") for i, p in enumerate(BASE)))
    every = F.concat(*(f"s{i}" for i in range(len(BASE))))
    named = F.array_compact(F.array(*(F.when(F.size(f"s{i}") > 0, F.lit(label)) for i, label in enumerate(BASE.values()))))
    marked = starts.select("row", "doc_id", "n_words", every.alias("at"), named.alias("base")).join(own, "row", "left")
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    both = F.concat("base", F.coalesce("own", F.array().cast("array<string>")))
    return marked.select(
        "doc_id", "n_words", F.size("at").cast("long").alias("n_base"), F.array_min("at").cast("long").alias("first_word"), F.array_max("at").cast("long").alias("last_word"), joined(F.col("base")).alias("base_labels"), joined(both).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score")
    )
