"""Licence notices found through a positional index of rare words."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerline.llm.common import ascii_lower, let, run_lengths

BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RARE_WORDS = 24  # rare words that a template is looked up by, at least
LEAST_SHARE = 0.75  # of a template's words that must stand at their places


@dataclass(frozen=True)
class Template:
    """A notice, and the phrases in it without which it is none."""

    label: str
    text: str
    phrases: tuple[str, ...]


# The phrases that name a licence wherever they stand, and the wording of notices.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
TEMPLATES = (
    Template("mit", "released under the mit license", ("under the mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Template("apache", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template(
        "apache",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0",
        ("in compliance with the license", "apache org licenses"),
    ),
    Template("gpl", "this work is licensed under the gnu general public license", ("gnu general public license",)),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
        ("free software", "gnu general public license"),
    ),
    Template(
        "lgpl",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license",
        ("lesser general public license",),
    ),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        ("redistribution and use in source and binary forms", "following conditions are met"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ("permission to use copy modify", "is hereby granted"),
    ),
    Template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("into the public domain",)),
)


def tokens(text: Column) -> Column:
    """Runs of letters and digits, A-Z lowered; letters beyond ASCII belong to words."""
    return F.filter(F.split(ascii_lower(text), BREAK), lambda w: w != "")


def _words_of(text: str) -> list[str]:
    return re.split(r"\s+", text.strip())


def document_frequencies(tokenised: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Documents, and how many of them hold each word of the templates (a number of words bounded by the templates)."""
    row = tokenised.select(
        F.filter(F.array_distinct("_ws"), lambda w: w.isin(vocabulary)).alias("held")
    )
    counted = row.select(F.explode(F.concat("held", F.array(F.lit("")))).alias("word")).groupBy("word").count()
    found = {r["word"]: r["count"] for r in counted.collect()}
    return found.pop("", 0), found


def _literal_lists(rows: list[list[str]]) -> Column:
    return F.array(*[F.array(*[F.lit(w) for w in row]) for row in rows])


def base_places(ws: Column, base: dict[str, str] = BASE) -> Column:
    """[(start, label)] of the phrases, in order; `ws` must be a column."""
    ends = {}
    for phrase, label in base.items():
        ends.setdefault(_words_of(phrase)[-1], []).append((_words_of(phrase), label))
    parts = []
    for last, phrases in ends.items():

        def place(w: Column, i: Column) -> Column:
            out = F.lit(None)
            for ph, label in phrases:  # noqa: B023
                hit = w == ph[-1]
                for back, word in enumerate(reversed(ph[:-1]), 1):
                    hit = hit & (F.get(ws, i - back) == word)
                out = F.when(hit, F.struct((i - len(ph) + 1).alias("start"), F.lit(label).alias("label"))).otherwise(out)
            return out

        hits = F.filter(F.transform(ws, place), lambda x: x.isNotNull())
        parts.append(F.when(F.array_contains(ws, last), hits))
    return F.array_sort(F.flatten(F.filter(F.array(*parts), lambda x: x.isNotNull())))


def scan(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    rare_words: int = RARE_WORDS,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """`doc_id` with words, base phrases and licences found in each text.

    Columns: n_words, n_base, first_word, last_word (long), base_labels, labels (string),
    score (double, the best share of a template's words standing at their places), places (template
    label, start, share of every notice verified).

    The document frequency of every template word over all documents ranks the words. Each template is
    indexed by its `rare_words` rarest words, and by more places than a notice may lack. Every occurrence of
    an indexed word in a file is looked up; postings (template, place) turn each into a start of that template. A
    notice that counts lacks no more places than it may, so the starts that as many of the template's own postings agree on as
    are left then hold every notice; they are read against the whole template. A notice counts if enough of its words stand
    at their places and each mandatory phrase is there in full. A null or empty text has no words and no
    licence, score 0; repeated rows are scanned alike; the templates bound everything that leaves the executors.
    """
    notices = [_words_of(t.text) for t in templates]
    vocabulary = sorted({w for n in notices for w in n})
    tokenised = docs.select("doc_id", tokens(F.col("text")).alias("_ws"))
    total, frequency = document_frequencies(tokenised, vocabulary)
    idf = {w: math.log((total + 1) / (frequency.get(w, 0) + 1)) for w in vocabulary}
    # Each notice is indexed by its rarest words; the order is by IDF, ties by the word.
    ranked = sorted(vocabulary, key=lambda w: (-idf[w], w))
    rank = {w: i for i, w in enumerate(ranked)}
    index: dict[str, list[tuple[int, int]]] = {}
    least = []  # own postings that any notice that counts still has
    for t, notice in enumerate(notices):
        may_lack = max(k for k in range(len(notice) + 1) if (len(notice) - k) / len(notice) >= least_share)
        posted_places = 0
        for n, w in enumerate(sorted(set(notice), key=rank.get)):
            # A word held by one document in five or more leads nowhere by itself, unless the rarer ones may all be lacking.
            if posted_places > may_lack and (n >= rare_words or idf[w] < math.log(5)):
                break
            places = [p for p, x in enumerate(notice) if x == w]
            index.setdefault(w, []).extend((t, p) for p in places)
            posted_places += len(places)
        least.append(max(1, posted_places - may_lack))
    listed = sorted(index, key=rank.get)
    posted = F.array(
        *[F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in index[w]]) for w in listed]
    )
    names = F.array(*[F.lit(w) for w in listed])

    def starts(hits: Column) -> Column:
        """Starts (template, start) that the file's indexed words point to."""
        return F.flatten(
            F.transform(
                hits,
                lambda h: F.transform(
                    F.element_at(posted, F.array_position(names, h["w"]).cast("int")),
                    lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["p"]).alias("s")),
                ),
            )
        )

    marked = F.transform(
        F.col("_ws"), lambda w, i: F.when(w.isin(listed), F.struct(i.alias("i"), w.alias("w")))
    )
    hits = F.filter(marked, lambda h: h.isNotNull())
    lengths = F.array(*[F.lit(len(n)) for n in notices])
    texts = _literal_lists(notices)
    phrases = F.array(*[_literal_lists([_words_of(p) for p in t.phrases]) for t in templates])
    labels = F.array(*[F.lit(t.label) for t in templates])

    def verified(e: Column) -> Column:
        t, s = e["value"]["t"], e["value"]["s"]
        piece = F.slice(F.col("_ws"), F.greatest(s, F.lit(0)) + 1, F.get(lengths, t) + F.least(s, F.lit(0)))

        def judge(v: Column) -> Column:
            lost = -F.least(s, F.lit(0))
            same = F.filter(F.get(texts, t), lambda w, i: F.get(v, (i - lost).cast("int")) == w)
            whole = F.forall(
                F.get(phrases, t),
                lambda ph: F.contains(
                    F.concat(F.lit(" "), F.array_join(v, " "), F.lit(" ")), F.concat(F.lit(" "), F.array_join(ph, " "), F.lit(" "))
                ),
            )
            return F.struct(
                F.get(labels, t).alias("label"),
                s.alias("start"),
                (F.size(same) / F.get(lengths, t)).alias("share"),
                whole.alias("phrases_there"),
            )

        return let(piece, judge)

    found = F.sort_array(starts(hits))
    needed = F.array(*[F.lit(k) for k in least])
    agreeing = F.filter(run_lengths(F.col("_starts")), lambda e: e["count"] >= F.get(needed, e["value"]["t"]))
    staged = tokenised.withColumn("_starts", found)
    staged = staged.withColumn("_base", F.when(F.size("_ws") > 1, base_places(F.col("_ws"))))
    staged = staged.withColumn(
        "_read", F.when(F.size("_starts") > 0, F.transform(agreeing, verified))
    )
    good = lambda e: e["phrases_there"] & (e["share"] >= least_share)
    base = F.coalesce("_base", F.array().cast("array<struct<start:int,label:string>>"))
    read = F.coalesce("_read", F.array().cast("array<struct<label:string,start:int,share:double,phrases_there:boolean>>"))
    staged = staged.select(
        "doc_id", F.size("_ws").cast("long").alias("n_words"), base.alias("_base"), F.filter(read, good).alias("places"), read.alias("_read")
    )
    joined = lambda *cols: F.array_join(F.array_sort(F.array_distinct(F.concat(*cols))), ",")
    named = F.transform("_base", lambda e: e["label"])
    return staged.select(
        "doc_id",
        "n_words",
        F.size("_base").cast("long").alias("n_base"),
        F.array_min(F.transform("_base", lambda e: e["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("_base", lambda e: e["start"])).cast("long").alias("last_word"),
        joined(named).alias("base_labels"),
        joined(named, F.transform("places", lambda e: e["label"])).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda e: e["share"])), F.lit(0.0)).alias("score"),
        F.transform("places", lambda e: F.struct(e["label"].alias("label"), e["start"].alias("start"), e["share"].alias("share"))).alias("places"),
    )
