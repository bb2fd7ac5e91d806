"""License scan by diagonal voting.

Every pair of consecutive words of a document is joined, by hash, to the places of the
same pair in the license templates. Word ``p`` of a document meeting word ``t`` of a
template votes for the diagonal ``p - t``: the place where the template would start. The
votes of a (document, template, diagonal) are gathered as a set of template places, the
sets of neighbouring diagonals are merged (words put in or left out move the rest of a
license to the next diagonal), and the share of template pairs found decides. A span counts
only if the words that tell its license from others stand there whole: those that a template
names as ``needed``, or all words of a template of fewer than ``SHORT``.

Everything is DataFrame functions. The templates are a parameter of bounded size and
broadcast; a document's words travel only with a pair that was found.

Results for odd input: a null text counts as empty; an empty text has no words, no labels
and score 0; a null ``doc_id`` is kept; equal rows (same ``doc_id`` and text) give one
result row each; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankmart.llm.common import ascii_words, text_key, text_or_empty

#: All templates, of any length, fit a broadcast.
MAX_TEMPLATES = 5_000
MAX_PLACES = 200_000
GAP = 3
THRESHOLD = 0.75
#: Templates of fewer words are needed whole: each of their words tells licenses apart.
SHORT = 8
_SELF = -1


@dataclass(frozen=True)
class Template:
    """ASCII words of a license, in lower case; ``exact`` asks for all of them in a row.

    ``needed`` are words of the text, in a row, without which it is another license.
    """

    label: str
    text: str
    exact: bool = False
    needed: str = ""

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def needed_places(self) -> list[int]:
        """Places of the pairs that a span must have."""
        words = self.words
        needed = self.needed.split() or (words if len(words) < SHORT else [])
        if not needed:
            return []
        starts = range(len(words) - len(needed) + 1)
        first = next((s for s in starts if words[s : s + len(needed)] == needed), None)
        if first is None or len(needed) < 2:
            raise ValueError(f"needed words are two or more of the text in a row: {self}")
        return list(range(first, first + len(needed) - 1))


#: The phrases and labels that are counted one by one.
BASE = [
    Template("gpl", "gnu general public license", exact=True),
    Template("apache", "apache license", exact=True),
    Template("cc-by", "cc by", exact=True),
    Template("mit", "mit license", exact=True),
]

#: Later paragraphs of licenses, for texts without the opening words.
PARAGRAPHS = [
    Template(
        "mit",
        "to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies "
        "of the software and to permit persons to whom the software is furnished to do so "
        "subject to the following conditions the above copyright notice and this permission "
        "notice shall be included in all copies or substantial portions of the software",
    ),
    Template(
        "mit",
        "the software is provided as is without warranty of any kind express or implied "
        "including but not limited to the warranties of merchantability fitness for a "
        "particular purpose and noninfringement in no event shall the authors or copyright "
        "holders be liable for any claim damages or other liability whether in an action of "
        "contract tort or otherwise arising from out of or in connection with the software "
        "or the use or other dealings in the software",
        needed="authors or copyright holders be liable",
    ),
    Template(
        "bsd",
        "redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer redistributions in binary form must "
        "reproduce the above copyright notice this list of conditions and the following "
        "disclaimer in the documentation and or other materials provided with the "
        "distribution",
    ),
    Template(
        "bsd",
        "this software is provided by the copyright holders and contributors as is and any "
        "express or implied warranties including but not limited to the implied warranties "
        "of merchantability and fitness for a particular purpose are disclaimed in no event "
        "shall the copyright holder or contributors be liable for any direct indirect "
        "incidental special exemplary or consequential damages including but not limited to "
        "procurement of substitute goods or services loss of use data or profits or "
        "business interruption however caused and on any theory of liability whether in "
        "contract strict liability or tort including negligence or otherwise arising in any "
        "way out of the use of this software even if advised of the possibility of such "
        "damage",
    ),
    Template(
        "isc",
        "the software is provided as is and the author disclaims all warranties with regard "
        "to this software including all implied warranties of merchantability and fitness "
        "in no event shall the author be liable for any special direct indirect or "
        "consequential damages or any damages whatsoever resulting from loss of use data or "
        "profits whether in an action of contract negligence or other tortious action "
        "arising out of or in connection with the use or performance of this software",
    ),
    Template(
        "apache",
        "unless required by applicable law or agreed to in writing software distributed "
        "under the license is distributed on an as is basis without warranties or "
        "conditions of any kind either express or implied see the license for the specific "
        "language governing permissions and limitations under the license",
    ),
]

#: Opening words of well-known licenses and notices.
TEXTS = [
    Template("agpl", "gnu affero general public license"),
    Template(
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file "
        "except in compliance with the license",
        needed="apache license",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "cc0 1 0 universal public domain dedication"),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the "
        "terms of the gnu general public license",
        needed="gnu general public license",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with "
        "or without fee is hereby granted",
    ),
    Template("lgpl", "gnu lesser general public license"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
    ),
    Template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license",
        needed="mozilla public license",
    ),
    Template("reserved", "all rights reserved"),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
    ),
    *PARAGRAPHS,
]


def _templates(spark, templates: Sequence[Template]) -> tuple[DataFrame, DataFrame]:
    """Pairs with their places, and one row for each template."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"at most {MAX_TEMPLATES} templates")
    pairs, known = [], []
    for number, template in enumerate(templates):
        words = template.words
        if len(words) < 2 or not template.text.isascii():
            raise ValueError(f"a template has two or more ASCII words: {template}")
        needed = template.needed_places
        known.append((number, template.label, template.exact, len(words) - 1, needed))
        pairs += [(number, t, *words[t : t + 2]) for t in range(len(words) - 1)]
    if len(pairs) > MAX_PLACES:
        raise ValueError(f"at most {MAX_PLACES} word pairs in all templates")
    places = spark.createDataFrame(
        [*pairs, (_SELF, 0, None, None)], "template int, place int, one string, two string"
    )
    pair = F.when(F.col("template") == _SELF, F.lit(0).cast("long")).otherwise(
        F.xxhash64("one", "two")
    )
    return places.withColumn("pair", pair), spark.createDataFrame(
        known, "template int, label string, exact boolean, pairs int, needed array<int>"
    )


def license_votes(
    docs: DataFrame, templates: Sequence[Template], id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Votes by (document, template, diagonal), and one row per document (template -1).

    ``found`` has the places of the template pairs that are there, ``copies`` is the number
    of equal rows.
    """
    places, _ = _templates(docs.sparkSession, templates)
    worded = docs.select(
        F.col(id).alias("doc"),
        text_key(text).alias("key"),
        ascii_words(text_or_empty(text)).alias("words"),
    )
    words = F.col("words")
    # The first element stands for the document itself and meets the template -1.
    pairs = F.concat(
        F.array(F.lit(0).cast("long")),
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1))),
    )
    each = worded.select("*", F.posexplode_outer(pairs).alias("at", "pair"))
    word = F.col("at") - 1
    same = (F.col("template") == _SELF) | (
        (F.get(words, word) == F.col("one")) & (F.get(words, word + 1) == F.col("two"))
    )
    hits = each.join(F.broadcast(places), "pair").filter(same)
    diagonal = F.when(F.col("template") == _SELF, 0).otherwise(word - F.col("place"))
    return (
        hits.select(
            "doc",
            "key",
            F.size("words").cast("long").alias("n_words"),
            "template",
            diagonal.cast("long").alias("diagonal"),
            "place",
        )
        .groupBy("doc", "key", "n_words", "template", "diagonal")
        .agg(F.collect_set("place").alias("found"), F.count(F.lit(1)).alias("copies"))
    )


def license_spans(
    votes: DataFrame, templates: Sequence[Template], gap: int = GAP
) -> DataFrame:
    """Adds ``merged`` (pairs found here or on the next ``gap`` diagonals) and ``coverage``.

    ``verified`` tells whether the needed pairs are all on one of these diagonals.
    """
    _, known = _templates(votes.sparkSession, templates)
    near = W.partitionBy("doc", "key", "template").orderBy("diagonal").rangeBetween(0, gap)
    spans = votes.join(F.broadcast(known), "template", "left")
    nearby = F.array_distinct(F.flatten(F.collect_list("found").over(near)))
    merged = F.when(F.col("exact"), F.col("found")).otherwise(nearby)
    whole = F.size(F.array_except("needed", "found")) == 0
    return spans.withColumns({"merged": merged, "verified": F.max(whole).over(near)}).withColumn(
        "coverage", F.size("merged") / F.col("pairs")
    )


def license_scan(
    docs: DataFrame,
    base: Sequence[Template] = tuple(BASE),
    texts: Sequence[Template] = tuple(TEXTS),
    gap: int = GAP,
    threshold: float = THRESHOLD,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: its licenses and where the base phrases stand.

    A base phrase counts at each place where all its words stand in a row. A text counts
    when at least ``threshold`` of its word pairs lie on diagonals within ``gap``, and the
    needed ones in a row.
    ``score`` is the largest share of any template that was found.
    """
    templates = [*base, *texts]
    spans = license_spans(license_votes(docs, templates, id, text), templates, gap)
    place = F.col("exact") & (F.size("found") == F.col("pairs"))
    text_found = ~F.col("exact") & (F.col("coverage") >= threshold) & F.col("verified")
    labelled = F.when(place | text_found, F.col("label"))

    def joined(label):
        return F.array_join(F.array_sort(F.collect_set(label)), ",")

    found = spans.groupBy("doc", "key", "n_words").agg(
        F.max(F.when(F.col("template") == _SELF, F.col("copies"))).alias("copies"),
        F.count_if(place).alias("n_base"),
        F.min(F.when(place, F.col("diagonal"))).alias("first_word"),
        F.max(F.when(place, F.col("diagonal"))).alias("last_word"),
        joined(F.when(place, F.col("label"))).alias("base_labels"),
        joined(labelled).alias("labels"),
        F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"),
    )
    return found.withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).select(
        F.col("doc").alias(id),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        "base_labels",
        "labels",
        "score",
    )
