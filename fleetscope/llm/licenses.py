"""License scans over a positional index of rare words (native).

A template is a notice with its mandatory key phrases. The index has the words
of all key phrases with their places. Each phrase is listed under its word of highest
IDF, counted over all texts: a text that holds the phrase holds that word.
So a file looks up its own words that are such rarest words, and gets the phrases that
may stand in it, however long the file is. The places of a phrase's two rarest words,
each less its place in the phrase, are intersected; at every start left the
phrase is verified word by word. A template stands in a file that holds
all of its key phrases; its score is the largest share of its words that stand in
their places, relative to a verified phrase.

Only DataFrame and SQL functions run. One aggregate counts in how many texts
each template word stands; its rows, as many as the templates have words, come to
the driver. The scan is row-local: no shuffle, no join, nothing to skew.
The plan holds the templates, which a library lists: their number is the bound.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import ascii_lower

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A notice of a license. ``keys``: phrases of ``text`` that must all stand in a file."""

    label: str
    text: str
    keys: tuple[str, ...]


# The base phrases and their labels.
BASE = (
    Template("mit", "mit license", ("mit license",)),
    Template("apache", "apache license", ("apache license",)),
    Template("gpl", "general public license", ("general public license",)),
)
# Sentences of public license notices.
MORE = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files, to deal in the software without restriction",
             ("permission is hereby granted free of charge", "associated documentation files")),
    Template("apache", "you may not use this file except in compliance with the license",
             ("except in compliance with the license",)),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3",
             ("under the gnu general public license", "version 3")),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU",
             ("you can redistribute it and or modify it", "under the terms of the gnu")),
    Template("lgpl", "the GNU Lesser General Public License", ("lesser general public license",)),
    Template("agpl", "the GNU Affero General Public License", ("affero general public license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met",
             ("use in source and binary forms", "with or without modification")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
             "is hereby granted", ("with or without fee is hereby granted",)),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License", ("mozilla public license",)),
    Template("cc", "Licensed under CC BY", ("under cc by",)),
    Template("cc", "Licensed under a Creative Commons Attribution license", ("creative commons attribution",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain",
             ("unencumbered software", "into the public domain")),
)
TEMPLATES = BASE + MORE


def words_of(text: str) -> list[str]:
    """The words of a template, as the scan takes them from a text."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def _phrases(templates) -> list[tuple[str, ...]]:
    """The distinct key phrases, as tuples of words."""
    return list(dict.fromkeys(tuple(words_of(k)) for t in templates for k in t.keys))


def _index(templates, count: dict[str, int]) -> list[dict]:
    """The phrases with their two words of highest IDF (fewest texts; ties: first places)."""
    out = []
    for phrase in _phrases(templates):
        by = sorted(range(len(phrase)), key=lambda i: (count.get(phrase[i], 0), i))
        first, second = by[0], by[min(1, len(by) - 1)]
        out.append({"id": len(out), "words": phrase, "rare": phrase[first], "at": first,
                    "next": phrase[second], "next_at": second})
    return out


_INDEX = "array<struct<id:int,words:array<string>,rare:string,at:int,next:string,next_at:int>>"
_TEMPLATES = "array<struct<label:string,words:array<string>,keys:array<int>,offsets:array<int>>>"


def _constant(value, schema: str) -> Column:
    """A literal of any nesting, folded when the plan is optimised."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def document_counts(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many rows of (words) each word of ``vocabulary`` stands."""
    own = F.array_intersect("words", F.array(*map(F.lit, vocabulary)))
    return dict(words.select(F.explode(own).alias("word")).groupBy("word").count().collect())


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES) -> DataFrame:
    """One row for each row of ``df``: key, n_words, places (phrase, start: every place of
    a key phrase, by start, then phrase; words from 0), labels (of the templates whose
    key phrases all stand; distinct, sorted) and score (0 to 1; 0 without a template).

    A-Z are lower-cased; words are ``WORD``. Null and empty texts have no words.
    Null keys and repeated rows are kept, each with its own findings; a
    phrase counts at every place, overlapping ones too. Other columns are ignored;
    an empty table gives no rows.
    """
    words = df.select(F.col(key).alias("key"),
                      F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit(""))),
                                           F.lit(WORD), F.lit(0)).alias("words"))
    phrases = _phrases(templates)
    index = _index(templates, document_counts(words, sorted({w for p in phrases for w in p})))
    number = {p: i for i, p in enumerate(phrases)}
    notices = [{"label": t.label, "words": words_of(t.text), "keys": [number[tuple(words_of(k))] for k in t.keys],
                "offsets": [_place(words_of(t.text), words_of(k)) for k in t.keys]} for t in templates]

    rare = F.array(*map(F.lit, sorted({p["rare"] for p in index})))
    due = F.filter(_constant(index, _INDEX), lambda p: F.array_contains("own", p.rare))
    looked = (words.select("key", "words", F.array_intersect("words", rare).alias("own"))
              .select("key", "words", F.when(F.size("own") > 0, due).alias("due")))
    sought = F.array_distinct(F.flatten(F.transform("due", lambda p: F.array(p.rare, p.next))))
    hits = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
                    lambda h: F.array_contains("sought", h.word))
    posted = (looked.select("key", "words", "due", F.when(F.size("due") > 0, sought).alias("sought"))
              .select("key", "words", "due", F.when(F.size("sought") > 0, hits).alias("hits")))

    def places(p: Column) -> Column:
        starts = lambda word, at: F.transform(
            F.filter("hits", lambda h: h.word == word), lambda h: h.at - at)
        both = F.array_intersect(starts(p.rare, p.at), starts(p.next, p.next_at))
        stands = F.filter(both, lambda s: (s >= 0) & (F.slice("words", F.greatest(s, F.lit(0)) + 1, F.size(p.words)) == p.words))
        return F.transform(stands, lambda s: F.struct(s.cast("long").alias("start"), p.id.alias("phrase")))

    none = F.array().cast("array<struct<start:bigint,phrase:int>>")
    placed = posted.select("key", "words", F.coalesce(
        F.when(F.size("hits") > 0, F.sort_array(F.flatten(F.transform("due", places)))), none).alias("spots"))

    held = F.array_distinct(F.transform("spots", lambda x: x.phrase))
    standing = F.filter(_constant(notices, _TEMPLATES), lambda t: F.forall(t["keys"], lambda k: F.array_contains("held", k)))
    found = (placed.select("key", "words", "spots", held.alias("held"))
             .select("key", "words", "spots", F.when(F.size("held") > 0, standing).alias("standing")))

    def share(t: Column, place: Column) -> Column:
        """Of the template's words, those in their places relative to the phrase at ``place``."""
        from_start = place.start - F.element_at(t.offsets, F.array_position(t["keys"], place.phrase).cast("int"))
        same = F.filter(F.transform(t.words, lambda w, i: F.get("words", (from_start + i).cast("int")) == w), lambda x: x)
        return F.size(same) / F.size(t.words)
    shares = F.flatten(F.transform("standing", lambda t: F.transform(
        F.filter("spots", lambda x: F.array_contains(t["keys"], x.phrase)), lambda x: share(t, x))))
    labels = F.sort_array(F.array_distinct(F.transform("standing", lambda t: t.label)))
    names = _constant([" ".join(p) for p in phrases], "array<string>")
    return found.select(
        F.col("key").alias(key), F.size("words").cast("long").alias("n_words"),
        F.transform("spots", lambda x: F.struct(F.get(names, x.phrase).alias("phrase"), x.start.alias("start"))).alias("places"),
        F.coalesce(labels, F.array().cast("array<string>")).alias("labels"),
        F.coalesce(F.array_max(shares), F.lit(0.0)).alias("score"))


def _place(words: list[str], phrase: list[str]) -> int:
    """Where ``phrase`` first stands in ``words``."""
    for i in range(len(words) - len(phrase) + 1):
        if words[i:i + len(phrase)] == phrase:
            return i
    raise ValueError(f"key phrase {' '.join(phrase)!r} is not in its template")
