"""Operator 12: licences in texts, found through their rarest words and proven by key phrases.

Only built-in functions, no Python on the rows. A text is split once; of its words those that
occur in a licence are kept with their places. How rare a licence word is, is counted over all
texts. Of each licence the rarest key word is looked up first, and the places of its other key
words, each less its place in the licence, are intersected with it from the rarest on.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonmart.llm.common import text_or_empty
from seasonmart.sources.sinks import Scratch, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: all of ASCII but digits and small letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Licence:
    """A label, words that announce the licence, and the phrases among them that have to be there."""

    label: str
    text: str
    keys: tuple[str, ...] = field(default=())

    @cached_property
    def words(self) -> list[str]:
        return self.text.split(" ")

    @cached_property
    def key_places(self) -> list[int]:
        """Places in ``words`` that key phrases cover; without key phrases, all of them."""
        found = set()
        for key in self.keys or (self.text,):
            phrase = key.split(" ")
            starts = [i for i in range(len(self.words)) if self.words[i : i + len(phrase)] == phrase]
            assert starts, key
            found |= set(range(starts[0], starts[0] + len(phrase)))
        return sorted(found)


# The phrases and labels of the base.
BASE = (
    Licence("mit", "mit license"),
    Licence("apache", "apache license"),
    Licence("gpl", "general public license"),
)
# How licences announce themselves, from their own public notices, in lower case and
# without punctuation, and what of it must be there word for word.
NOTICES = (
    Licence(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "associated documentation files"),
    ),
    Licence(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license",
        ("apache license version 2 0",),
    ),
    Licence(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation",
        ("free software you can redistribute it", "gnu general public license"),
    ),
    Licence("gpl-2.0", "licensed under the gnu general public license version 2", ("general public license version 2",)),
    Licence("gpl-3.0", "licensed under the gnu general public license version 3", ("general public license version 3",)),
    Licence(
        "lgpl",
        "under the terms of the gnu lesser general public license as published by the free software foundation",
        ("lesser general public license",),
    ),
    Licence(
        "agpl",
        "under the terms of the gnu affero general public license as published by the free software foundation",
        ("affero general public license",),
    ),
    Licence(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Licence(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license v 2 0",),
    ),
    Licence(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted",
        ("permission to use copy modify", "with or without fee is hereby granted"),
    ),
    Licence(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software released into the public domain",),
    ),
    Licence("epl", "made available under the terms of the eclipse public license", ("eclipse public license",)),
    Licence("boost", "distributed under the boost software license version 1 0", ("boost software license",)),
    Licence("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    Licence("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    Licence("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Licence("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Licence("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Licence(
        "cc-by",
        "licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0",),
    ),
    Licence(
        "cc-by-nc",
        "licensed under a creative commons attribution noncommercial 4 0 international license",
        ("creative commons attribution noncommercial",),
    ),
    Licence(
        "cc-by-sa",
        "licensed under a creative commons attribution sharealike 4 0 international license",
        ("creative commons attribution sharealike",),
    ),
)


def licence_words(docs: DataFrame, licences: tuple[Licence, ...], doc_id: str, text: str) -> DataFrame:
    """doc_id, n_words, hits: a text's licence words and their places, in order.

    All words of a licence are kept, so a hit's neighbours in the licence are hits as well.
    """
    known = sorted({w for licence in licences for w in licence.words})
    words = F.split(F.translate(text_or_empty(text), UPPER, LOWER), BETWEEN)
    words = docs.select(F.col(doc_id).alias("doc_id"), F.filter(words, lambda w: w != "").alias("words"))
    hits = F.transform("words", lambda w, i: F.when(w.isin(known), F.struct(w.alias("word"), i.alias("at"))))
    return words.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.filter(hits, lambda h: h.isNotNull()).alias("hits")
    )


def rarity(hits: DataFrame) -> dict[str, int]:
    """In how many texts each licence word occurs, over all texts: at most as many rows as licences have words."""
    each = hits.select(F.explode(F.array_distinct("hits.word")).alias("word"))
    return {r.word: r.n for r in each.groupBy("word").agg(F.count("*").alias("n")).collect()}


def _starts(word: str, place: int) -> Column:
    """Where a licence would begin whose word at ``place`` is this one."""
    return F.transform(F.filter("hits", lambda h: h["word"] == word), lambda h: h["at"] - place)


def _found(licence: Licence, texts_with: dict[str, int]) -> Column:
    """starts: where the licence's key words all stand at their places; matched: words that agree at the first."""
    rarest_first = sorted(licence.key_places, key=lambda p: (texts_with.get(licence.words[p], 0), p))
    nowhere = F.array().cast("array<int>")
    starts = _starts(licence.words[rarest_first[0]], rarest_first[0])
    for place in rarest_first[1:]:
        starts = F.array_intersect(starts, _starts(licence.words[place], place))
    starts = F.when(F.array_contains("hits.word", licence.words[rarest_first[0]]), starts).otherwise(nowhere)
    template = F.array(*(F.lit(w) for w in licence.words))

    def agreeing(first: Column) -> Column:
        return F.size(F.filter("hits", lambda h: F.get(template, h["at"] - first) == h["word"]))

    # Bound to names by a transform, so that each is worked out once.
    bound = F.transform(
        F.array(starts),
        lambda s: F.struct(
            s.alias("starts"),
            F.element_at(F.transform(F.array(F.array_min(s)), lambda f: F.when(f.isNotNull(), agreeing(f))), 1).alias("matched"),
        ),
    )
    return F.element_at(bound, 1)


def license_scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    base: tuple[Licence, ...] = BASE,
    notices: tuple[Licence, ...] = NOTICES,
) -> DataFrame:
    """One row per document: the licences that its text names or announces, and where.

    Columns: doc_id, n_words, n_base (places of base phrases), first_word and last_word (least and
    largest start of those, words counted from 0), base_labels, labels (of base and notices), score,
    places (array of label, start, words). A licence is found where all of its key phrases stand,
    word for word, at the distance that they have in the notice; ``start`` is where the first one
    does. Score: 0 without a label, else a half plus half the share of a notice's words that agree
    at its first place, the largest share of all notices found.

    Every word of a text that is the rarest key word of some licence is looked up, so no place is
    lost; how rare words are decides the order of look-ups only. The driver sees one count for
    each word of the licences.

    Defined results: a null text is empty: no words, no places, empty labels, score 0. Texts of any
    length are scanned whole. Repeated rows are scanned each for itself; a null doc_id stays
    null. An empty table gives an empty result. Other columns are left out.
    """
    licences = (*base, *notices)
    with Scratch(docs.sparkSession, "license_scan") as scratch:
        hits = scratch.stage(licence_words(docs, licences, doc_id, text), "hits")
        texts_with = rarity(hits)
        found = hits.select("doc_id", "n_words", *(_found(x, texts_with).alias(f"l{i}") for i, x in enumerate(licences)))
        found = scratch.stage(found, "found")

        def places(i: int) -> Column:
            first, words = licences[i].key_places[0], licences[i].key_places[-1] - licences[i].key_places[0] + 1
            return F.transform(
                f"l{i}.starts",
                lambda s: F.struct(
                    F.lit(licences[i].label).alias("label"), (s + first).cast("long").alias("start"),
                    F.lit(words).alias("words"),
                ),
            )

        def labels(numbers: range) -> Column:
            names = F.array(*(F.when(F.size(f"l{i}.starts") > 0, licences[i].label) for i in numbers))
            return F.array_join(F.array_sort(F.array_distinct(F.array_compact(names))), ",")

        named, noticed = range(len(base)), range(len(base), len(licences))
        starts = F.flatten(F.array(*(F.transform(f"l{i}.starts", lambda s: s.cast("long")) for i in named)))
        shares = [
            F.coalesce(F.col(f"l{i}.matched") / F.lit(float(len(licences[i].words))), F.lit(0.0)) for i in noticed
        ]
        best = F.array_max(F.array(F.lit(0.0), *shares))
        result = found.select(
            "doc_id", "n_words",
            F.size(starts).cast("long").alias("n_base"),
            F.array_min(starts).alias("first_word"),
            F.array_max(starts).alias("last_word"),
            labels(named).alias("base_labels"),
            labels(range(len(licences))).alias("labels"),
            best.alias("best"),
            F.flatten(F.array(*(places(i) for i in range(len(licences))))).alias("places"),
        )
        score = F.when(F.col("labels") == "", 0.0).otherwise(F.lit(0.5) + F.lit(0.5) * F.col("best"))
        return stage(result.withColumn("score", score).drop("best"), "license_scan")


def _sql_words(licences: tuple[Licence, ...]) -> str:
    rows = (
        f"({i}, '{x.label}', {i < len(BASE)}, {len(x.words)}, {x.key_places[0]}, {p}, '{w}', {p in x.key_places})"
        for i, x in enumerate(licences)
        for p, w in enumerate(x.words)
    )
    return f"(values {', '.join(rows)}) as t(licence, label, is_base, size, first_key, place, word, is_key)"


SQL = rf"""
with texts as (
    select row_number() over () as id, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from documents
),
spread as (select id, unnest(words) as word, unnest(range(len(words))) as place from texts),
licences as (select *, count(*) filter (is_key) over (partition by licence) as n_keys from {_sql_words((*BASE, *NOTICES))}),
places as (
    select id, licence, label, is_base, size, s.place - l.place as start, min(first_key) as first_key, count(*) as matched
    from spread s join licences l using (word)
    group by all having count(*) filter (is_key) = min(n_keys)
),
firsts as (
    select id, licence, is_base, size, arg_min(matched, start) as matched from places group by id, licence, is_base, size
),
shares as (select id, max(matched / cast(size as double)) as share from firsts where not is_base group by id),
found as (
    select id, count(*) filter (is_base) as n_base,
        min(start + first_key) filter (is_base) as first_word, max(start + first_key) filter (is_base) as last_word,
        string_agg(distinct label, ',' order by label) filter (is_base) as base_labels,
        string_agg(distinct label, ',' order by label) as labels
    from places group by id
)
select doc_id, len(words) as n_words, coalesce(n_base, 0) as n_base, cast(first_word as bigint) as first_word,
    cast(last_word as bigint) as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
    case when labels is null then cast(0 as double) else cast(0.5 as double) + cast(0.5 as double) * coalesce(share, 0) end as score
from texts left join found using (id) left join shares using (id)"""
