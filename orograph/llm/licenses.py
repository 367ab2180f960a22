"""Licence notices in texts: phrases, and an exact containment join of word windows with templates, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import BETWEEN, let, lower_ascii
from .words import fresh

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Public notices, whole and by their telling sentences, and short licence lines, by label.
TEMPLATES = [
    ("apache", "Licensed under the Apache License"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    (
        "apache",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
    http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
    WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    ),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must
    retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
    the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS
    OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    ),
    ("bsl", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "This work is licensed under the GNU General Public License"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    (
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the
    License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS
    FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    ),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice
    appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.""",
    ),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction,
    including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
    subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS",
    WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    ),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("reserved", "All rights reserved"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("wtfpl", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software"),
]


def words(text: str) -> list[str]:
    """Words of a template, as in texts."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return "".join(c if c in "0123456789" or "a" <= c <= "z" or ord(c) > 127 else " " for c in low).split()


def tokens(text: str) -> list[str]:
    return sorted(set(words(text)))


def need(text: str, threshold: float) -> int:
    """How many of its distinct words a window must have."""
    return max(1, math.ceil(threshold * len(tokens(text)) - 1e-9))


def width(text: str, threshold: float) -> int:
    """Words of the windows that are held against a template."""
    return math.ceil(len(words(text)) / threshold - 1e-9)


def strings(values: list[str]) -> Column:
    return F.array(*(F.lit(v) for v in values)) if values else F.array().cast("array<string>")


def spaced(text: Column) -> Column:
    """The words of a text, lower case, with two blanks between them and none around."""
    return F.btrim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN, "  "))


def split(inner: Column) -> Column:
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, "  "))


def by_rarity(docs: DataFrame, vocabulary: list[str], text: str) -> list[str]:
    """The templates' words, those first that the fewest texts have; counted over all texts, a row for each word."""
    found = docs.select(F.explode(F.array_intersect(strings(vocabulary), split(spaced(docs[text])))).alias("token"))
    counts = {r.token: r.n for r in found.groupBy("token").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda t: (counts.get(t, 0), t))


MATCHES = "array<struct<start:int,label:string,containment:double>>"


def joined(ws: Column, order: list[str], templates: list[tuple[str, str]], threshold: float) -> Column:
    """MATCHES of a list of words: windows (as many words as the template has, divided by the threshold) with at least `threshold` of a template's distinct words.

    Words are in one global order, rarest first. A window that has `need` of a template's n words has one of its first n - need + 1 (prefix
    filter), so an index of these leads from the words of the text to templates; texts with too few of a template's words go (length filter). The rarest word that
    a window shares has all others of them after it in that order: a place is only looked at if enough words that are no rarer are in its reach (positional filter).
    Windows begin with a word of the template; of those that overlap the fullest and first is given."""
    rank = {t: i for i, t in enumerate(order)}
    plans, index = [], {}
    for i, (label, template) in enumerate(templates):
        own = sorted(tokens(template), key=rank.__getitem__)
        least = need(template, threshold)
        plans.append(F.struct(F.lit(label).alias("label"), strings(own).alias("own"), strings(own[: len(own) - least + 1]).alias("head"), F.lit(least).alias("need"), F.lit(width(template, threshold)).alias("width")))
        for t in own[: len(own) - least + 1]:
            index.setdefault(t, []).append(i)
    none = F.array().cast(MATCHES)
    if not index:
        return none
    heads = sorted(index)
    of_head = F.create_map(*(x for t in heads for x in (F.lit(t), F.array(*map(F.lit, index[t])))))

    def of_template(p: Column, places: Column) -> Column:
        def able(q: Column) -> Column:
            first = F.greatest(F.lit(0), q["i"] - p["width"] + 1)
            after = F.slice(p["own"], F.array_position(p["own"], q["w"]).cast("int"), F.size(p["own"]))
            return F.array_contains(p["head"], q["w"]) & (F.size(F.array_intersect(after, F.slice(ws, first + 1, q["i"] - first + p["width"]))) >= p["need"])

        def starts(q: Column) -> Column:
            return F.filter(F.sequence(F.greatest(F.lit(0), q["i"] - p["width"] + 1), q["i"]), lambda s: F.array_contains(p["own"], F.get(ws, s)))

        def best(hits: Column) -> Column:
            def add(kept: Column, h: Column) -> Column:
                last = F.get(kept, F.size(kept) - 1)
                clear = (F.size(kept) == 0) | (h["start"] >= last["start"] + p["width"])
                return F.when(clear, F.concat(kept, F.array(h))).when(h["n"] > last["n"], F.concat(F.slice(kept, F.lit(1), F.size(kept) - 1), F.array(h))).otherwise(kept)

            return F.aggregate(hits, F.array().cast("array<struct<start:int,n:int>>"), add)

        near = F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(places, able), starts))))
        hits = F.transform(near, lambda s: F.struct(s.cast("int").alias("start"), F.size(F.array_intersect(p["own"], F.slice(ws, s + 1, p["width"]))).alias("n")))
        return F.when(F.size(near) == 0, none).otherwise(
            F.transform(best(F.filter(hits, lambda h: h["n"] >= p["need"])), lambda h: F.struct(h["start"].alias("start"), p["label"].alias("label"), (h["n"] / F.size(p["own"]).cast("double")).alias("containment")))
        )

    def found(places: Column) -> Column:
        which = F.array_sort(F.array_distinct(F.flatten(F.transform(places, lambda q: F.element_at(of_head, q["w"])))))
        # length filter: the whole text must have enough of the template's words
        open_ = F.filter(F.transform(which, lambda t: F.get(F.array(*plans), t)), lambda p: F.size(F.array_intersect(p["own"], ws)) >= p["need"])
        return F.flatten(F.transform(open_, lambda p: of_template(p, places)))

    places = F.filter(F.transform(ws, lambda w, i: F.struct(i.alias("i"), w.alias("w"))), lambda x: x["w"].isin(heads))
    return F.when(F.arrays_overlap(ws, strings(heads)), let(places, found)).otherwise(none)


def phrases(inner: Column) -> Column:
    """struct<n_words, n_base, first_word, last_word, base_labels array> of words with two blanks between them."""

    def spaces(s: Column) -> Column:
        return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))

    def of(w: Column) -> Column:
        # each word between blanks of its own, so that places don't share a blank
        pads = {p: " " + p.replace(" ", "  ") + " " for p in PHRASES}
        n = [F.when(w.contains(s), (F.length(w) - F.length(F.replace(w, F.lit(s), F.lit("")))) / len(s)).otherwise(0).cast("long") for s in pads.values()]
        first = [F.when(w.contains(s), spaces(F.substring(w, F.lit(1), F.locate(s, w) - 1)) / 2) for s in pads.values()]
        last = [F.when(w.contains(s), spaces(F.substring(w, F.lit(1), F.length(w) - F.locate(s[::-1], F.reverse(w)) + 1 - len(s))) / 2) for s in pads.values()]
        labels = [F.when(w.contains(s), F.lit(PHRASES[p])) for p, s in pads.items()]
        return F.struct(
            (spaces(w) / 2).cast("long").alias("n_words"), sum(n[1:], n[0]).alias("n_base"), F.least(*first).cast("long").alias("first_word"), F.greatest(*last).cast("long").alias("last_word"),
            F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))).alias("base_labels"),
        )

    return let(F.when(inner == "", F.lit("")).otherwise(F.concat(F.lit(" "), inner, F.lit(" "))), of)


def scan(docs: DataFrame, *, text: str = "text", templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.9, keep: list[str] | None = None) -> DataFrame:
    """`keep` (default: all columns) and n_words, n_base, first_word, last_word, base_labels, matches, labels, score.

    Blocks are windows of words, wherever lines end, so that wrapped notices are met like others. matches has, for each template, the windows whose containment of its
    distinct words reaches the threshold (start: their first word, from 0), the fullest of those that overlap: no candidate is left out. labels joins the labels of phrases
    and matches. score is 1 with a phrase, else the largest containment of a match, else 0. The templates are a parameter and part of the plan; the corpus gives only one
    count for each of their words. Texts of any length are gone through whole; work grows with the words and the places of rare template words. Null or empty text: no words, places
    null, no labels, score 0. Repeated rows each get the same values, no rows give no rows. Columns with the new names give way, others may have any name."""
    new = ["n_words", "n_base", "first_word", "last_word", "base_labels", "matches", "labels", "score"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    order = by_rarity(docs, sorted({t for _, x in templates for t in tokens(x)}), text)
    (made,) = fresh(docs, "found")

    def of(inner: Column) -> Column:
        return F.struct(phrases(inner).alias("p"), let(split(inner), lambda ws: joined(ws, order, templates, threshold)).alias("m"))

    found = docs.select(*(docs[c] for c in kept), let(spaced(docs[text]), of).alias(made))
    labels = F.array_sort(F.array_union("base_labels", F.transform("matches", lambda m: m["label"])))
    score = F.when(F.size("base_labels") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)))
    return found.select(*kept, f"{made}.p.*", F.col(f"{made}.m").alias("matches")).select("*", labels.alias("labels"), score.alias("score"))
