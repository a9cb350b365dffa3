"""Licence detection with a positional index of rare words, in DataFrame operations only.

Every template is indexed by the words of it that the fewest documents of the corpus hold. A document's index
words are looked up, its places are set against the places in the templates, and words that agree on where a
template would begin add up by inverse document frequency. A template that enough of its weight supports is
reported if each of its key phrases stands there word for word; where wordings differ in a version or a name only, the
phrases hold these. Phrases that by themselves name a licence are found at the same time, as templates whose every word
counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Words are runs of letters, digits and other characters beyond ASCII; case is that of A-Z only.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Index words of a template: the half of its words, and no more than these, of the highest inverse document
#: frequency. Common words would make hits of most of a corpus.
RARE_WORDS = 8
#: Words that a copy may have more or fewer than the template before two index words.
SLACK = 4
#: Share of a template's weight that makes it a candidate.
LEAST_SHARE = 0.6

# Phrases that name a licence, and the labels they stand for.
BASE_PHRASES = {"mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: All of them must stand in the copy.
    key_phrases: tuple[str, ...]


def _notice(label: str, name: str, version: str) -> Template:
    """The notice that asks for a version of a public licence or any later one."""
    text = f"you can redistribute it and or modify it under the terms of the {name} as published by the free software foundation either version {version} of the license or at your option any later version"
    return Template(label, text, (name, f"either version {version}"))


def _identifier(label: str, name: str) -> Template:
    """The line that names a licence for machines."""
    return Template(label, f"spdx license identifier {name}", (f"identifier {name}",))


# Wording of public licences and of the notices that refer to them, in lower case without marks.
TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("hereby granted free",)),
    Template("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", ("particular purpose and noninfringement",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license", ("apache license version 2",)),
    Template("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    Template("apache-2", "apache license version 2 0 january 2004 http www apache org licenses", ("apache license version 2",)),
    Template("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", ("required by applicable law", "distributed on an as is basis")),
    _notice("gpl-2", "gnu general public license", "2"),
    _notice("gpl-3", "gnu general public license", "3"),
    _notice("lgpl", "gnu lesser general public license", "2"),
    _notice("lgpl", "gnu lesser general public license", "3"),
    _notice("agpl-3", "gnu affero general public license", "3"),
    Template("gpl-2", "under the terms of version 2 of the gnu general public license as published by the free software foundation", ("version 2 of the gnu general public license",)),
    Template("gpl-3", "under the terms of version 3 of the gnu general public license as published by the free software foundation", ("version 3 of the gnu general public license",)),
    Template("gpl-2", "gnu general public license version 2 june 1991 copyright c 1989 1991 free software foundation", ("gnu general public license", "version 2 june 1991")),
    Template("gpl-3", "gnu general public license version 3 29 june 2007 copyright c 2007 free software foundation", ("gnu general public license", "version 3 29 june 2007")),
    Template("lgpl", "gnu lesser general public license version 3 29 june 2007 copyright c 2007 free software foundation", ("gnu lesser general public license", "version 3 29 june 2007")),
    Template("agpl-3", "gnu affero general public license version 3 19 november 2007 copyright c 2007 free software foundation", ("gnu affero general public license", "version 3 19 november 2007")),
    Template("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2", "released under the gnu gpl version 2", ("gnu gpl version 2",)),
    Template("gpl-3", "released under the gnu gpl version 3", ("gnu gpl version 3",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl-3", "licensed under the gnu affero general public license version 3", ("gnu affero general public license version 3",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("source and binary forms",)),
    Template("bsd", "released under the bsd license", ("bsd license",)),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2",)),
    Template("mpl-2", "licensed under the mozilla public license version 2 0", ("mozilla public license version 2",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("distribute this software",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4",)),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc0", "to the extent possible under law the author has waived all copyright under cc0 1 0 universal", ("waived all copyright",)),
    _identifier("mit", "mit"),
    _identifier("apache-2", "apache 2 0"),
    _identifier("gpl-2", "gpl 2 0"),
    _identifier("gpl-3", "gpl 3 0"),
    _identifier("lgpl", "lgpl 2 1"),
    _identifier("lgpl", "lgpl 3 0"),
    _identifier("agpl-3", "agpl 3 0"),
    _identifier("bsd", "bsd 2 clause"),
    _identifier("bsd", "bsd 3 clause"),
    _identifier("mpl-2", "mpl 2 0"),
    _identifier("isc", "isc"),
    _identifier("cc0", "cc0 1 0"),
)


def words(text: Column) -> Column:
    """All words of a text in order; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def document_frequencies(docs: DataFrame, vocabulary: list[str], text: str = "text") -> tuple[int, dict[str, int]]:
    """Documents in all, and those that hold each word of the vocabulary: one count per word reaches the driver."""
    known = F.array(*[F.lit(w) for w in vocabulary])
    held = docs.select(F.explode(F.array_append(F.array_intersect(words(F.lower(text)), known), "")).alias("word"))
    found = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return found.pop("", 0), found


def build_index(templates: tuple[Template, ...], n_docs: int, frequencies: dict[str, int]) -> list[tuple]:
    """(template number, word, place, weight) of every template's rarest words; weights of one add up to 1."""
    index = []
    for number, template in enumerate(templates):
        split = template.text.split()
        rarity = {w: math.log((n_docs + 2) / (frequencies.get(w, 0) + 1)) for w in split}
        rare = sorted(set(split), key=lambda w: (-rarity[w], split.index(w)))
        rare = rare[: min(RARE_WORDS, -(-len(rare) // 2))]
        places = [(i, w) for i, w in enumerate(split) if w in rare]
        total = sum(rarity[w] for _, w in places)
        index += [(number, w, i, rarity[w] / total) for i, w in places]
    return index


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score`` per row.

    Base places are those of ``BASE_PHRASES``; ``labels`` adds the labels of verified templates; ``score`` is the
    largest share of a verified template's weight, 1 for a base phrase, 0 for none. Null texts are empty, texts are
    read whole, and no other columns are read. Rows
    are kept apart by a number of their own, so repeated and null keys do no harm. The index and the phrases
    are of fixed size and are broadcast; a document's words meet them inside its task, and only hits are
    grouped, by document.
    """
    spark = docs.sparkSession
    phrases = sorted(set(BASE_PHRASES) | {p for t in templates for p in t.key_phrases})
    everything = sorted({w for t in templates for w in t.text.split()} | {w for p in phrases for w in p.split()})
    n_docs, frequencies = document_frequencies(docs, everything, text)
    index = build_index(templates, n_docs, frequencies)
    wanted = sorted({e[1] for e in index} | {p.split()[0] for p in phrases})
    # a later word of a phrase, which may be a common one, counts only behind the word before it
    later = sorted({w for p in phrases for w in p.split()[1:]} - set(wanted))
    pairs = sorted({f"{a} {b}" for p in phrases for a, b in zip(p.split(), p.split()[1:]) if b in later})

    all_words = words(F.col("t"))

    def kept(w: Column, i: Column) -> Column:
        low = F.lower(w)
        behind = low.isin(later) & F.concat_ws(" ", F.lower(F.get(F.col("w"), i - 1)), low).isin(pairs)
        return F.when(low.isin(wanted) | behind, F.struct(i.cast("long").alias("place"), low.alias("word")))

    hit = F.transform("w", kept)
    rows = docs.select(docs[key].alias("k"), docs[text].alias("t")).select("k", all_words.alias("w"))
    # the hits of a row are written once, so the numbers given to rows stay
    rows = stored(
        rows.select(F.monotonically_increasing_id().alias("row"), "k", F.size("w").cast("long").alias("n_words"), F.filter(hit, lambda h: h.isNotNull()).alias("hits"))
    )
    hits = rows.filter(F.size("hits") > 0).select("row", F.explode("hits").alias("hit")).select("row", "hit.place", "hit.word")

    steps = [(number, w, i, len(p.split())) for number, p in enumerate(phrases) for i, w in enumerate(p.split())]
    phrase_words = spark.createDataFrame(steps, "phrase int, word string, step long, size long")
    places = (
        hits.join(F.broadcast(phrase_words), "word")
        .groupBy("row", "phrase", (F.col("place") - F.col("step")).alias("start"), "size")
        .agg(F.count("*").alias("n"))
        .filter("n = size")
        .select("row", "phrase", "start")
    )
    places = stored(places)

    base_rows = [(phrases.index(p), label) for p, label in BASE_PHRASES.items()]
    base_labels = spark.createDataFrame(base_rows, "phrase int, label string")
    joined_labels = F.array_join(F.array_sort(F.collect_set("label")), ",")
    base = (
        places.join(F.broadcast(base_labels), "phrase")
        .groupBy("row")
        .agg(F.count("*").alias("n_base"), F.min("start").alias("first_word"), F.max("start").alias("last_word"), joined_labels.alias("base_labels"))
    )

    entries = spark.createDataFrame(index, "template int, word string, offset long, weight double")
    window = F.floor((F.col("place") - F.col("offset")) / SLACK)
    support = (
        hits.join(F.broadcast(entries), "word")
        .select("row", "template", "offset", "weight", F.explode(F.array(window, window + 1)).alias("window"))
        .groupBy("row", "template", "window", "offset")
        .agg(F.first("weight").alias("weight"))
        .groupBy("row", "template", "window")
        .agg(F.sum("weight").alias("share"))
        .filter(F.col("share") >= LEAST_SHARE)
    )
    about = [(n, t.label, phrases.index(p), len(t.text.split()), len(t.key_phrases)) for n, t in enumerate(templates) for p in t.key_phrases]
    told = F.broadcast(spark.createDataFrame(about, "template int, label string, phrase int, size long, n_phrases long"))
    begin = (F.col("window") - 1) * SLACK
    verified = (
        support.join(told, "template")
        .join(places, ["row", "phrase"])
        .filter(F.col("start").between(begin - SLACK, begin + F.col("size") + 3 * SLACK))
        .groupBy("row", "label", "share", "template", "window", "n_phrases")
        .agg(F.count_distinct("phrase").alias("n"))
        .filter("n = n_phrases")
        .select("row", "label", "share")
    )
    named = places.join(F.broadcast(base_labels), "phrase").select("row", "label", F.lit(1.0).alias("share"))
    labels = verified.union(named).groupBy("row").agg(joined_labels.alias("labels"), F.max("share").alias("score"))

    return (
        rows.select("row", "k", "n_words")
        .join(base, "row", "left")
        .join(labels, "row", "left")
        .select(
            F.col("k").alias(key),
            "n_words",
            F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
            "first_word",
            "last_word",
            F.coalesce("base_labels", F.lit("")).alias("base_labels"),
            F.coalesce("labels", F.lit("")).alias("labels"),
            F.least(F.coalesce("score", F.lit(0.0)), F.lit(1.0)).alias("score"),
        )
    )
