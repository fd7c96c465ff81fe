"""Licences in texts, by known sentences and ordered rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripguard.llm.common import table

# Sentences of public licences and of usual references to them,
# lower-cased, with everything but letters, digits and + as one space. A lead
# such as "this work is licensed under the" is the word "under".
SENTENCES = {
    "spdx-tag": ["spdx license identifier"],
    "mit-ref": ["under mit license", "mit license", "the mit license", "under mit"],
    "mit-grant": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files the software to deal in the software without restriction including"
        " without limitation the rights to use copy modify merge publish distribute sublicense and or sell"
        " copies of the software and to permit persons to whom the software is furnished to do so subject to"
        " the following conditions"
    ],
    "mit-notice": [
        "the above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the software"
    ],
    "mit-as-is": [
        "the software is provided as is without warranty of any kind express or implied including but not"
        " limited to the warranties of merchantability fitness for a particular purpose and noninfringement"
    ],
    "mit-liability": [
        "in no event shall the authors or copyright holders be liable for any claim damages or other"
        " liability whether in an action of contract tort or otherwise arising from out of or in connection"
        " with the software or the use or other dealings in the software"
    ],
    "isc-grant": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee"
        " is hereby granted provided that the above copyright notice and this permission notice appear in"
        " all copies"
    ],
    "bsd-grant": [
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met"
    ],
    "bsd-source": [
        "redistributions of source code must retain the above copyright notice this list of conditions and"
        " the following disclaimer"
    ],
    "bsd-binary": [
        "redistributions in binary form must reproduce the above copyright notice this list of conditions"
        " and the following disclaimer in the documentation and or other materials provided with the"
        " distribution"
    ],
    "bsd-endorse": [
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse"
        " or promote products derived from this software without specific prior written permission"
    ],
    "bsd2-ref": ["under bsd 2 clause license", "under simplified bsd license", "bsd 2 clause license"],
    "bsd3-ref": ["under bsd 3 clause license", "under new bsd license", "bsd 3 clause license", "under bsd license"],
    "apache-ref": [
        "under apache license version 2 0",
        "under apache license 2 0",
        "under apache 2 0 license",
        "apache license version 2 0",
        "under apache license version 2 0 the license",
    ],
    "apache-comply": [
        "you may not use this file except in compliance with the license",
        "under apache license version 2 0 the license you may not use this file except in compliance with"
        " the license",
    ],
    "apache-copy": ["you may obtain a copy of the license at"],
    "apache-as-is": [
        "unless required by applicable law or agreed to in writing software distributed under the license"
        " is distributed on an as is basis without warranties or conditions of any kind either express or"
        " implied"
    ],
    "apache-see": [
        "see the license for the specific language governing permissions and limitations under the license"
    ],
    "gpl3-ref": [
        "under gnu general public license version 3",
        "under gnu general public license v3",
        "under gnu gpl version 3",
        "under gplv3",
        "gnu general public license version 3",
    ],
    "gpl2-ref": [
        "under gnu general public license version 2",
        "under gnu general public license v2",
        "under gplv2",
    ],
    "lgpl3-ref": ["under gnu lesser general public license version 3", "under lgplv3"],
    "agpl3-ref": ["under gnu affero general public license version 3", "under agplv3"],
    "gpl-free": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu"
        " general public license as published by the free software foundation either version 3 of the"
        " license or at your option any later version"
    ],
    "gpl-hope": [
        "this program is distributed in the hope that it will be useful but without any warranty without"
        " even the implied warranty of merchantability or fitness for a particular purpose"
    ],
    "gpl-see": ["see the gnu general public license for more details"],
    "mpl2-ref": [
        "under mozilla public license version 2 0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ],
    "cc-by-ref": ["under cc by 4 0", "under creative commons attribution 4 0 international license"],
    "cc-by-sa-ref": [
        "under cc by sa 4 0",
        "under creative commons attribution sharealike 4 0 international license",
    ],
    "cc-by-nc-ref": [
        "under cc by nc 4 0",
        "under creative commons attribution noncommercial 4 0 international license",
    ],
    "cc0-ref": ["under cc0 1 0", "under cc0", "under cc0 1 0 universal license"],
    "reserved": ["all rights reserved"],
}
# Rules in the order they are tried. Sentences stand one after
# the other; a name with ? may be missing. Notices and titles may precede.
RULES = [
    ("MIT", ["mit-ref?", "copyright?", "reserved?", "mit-grant", "mit-notice", "mit-as-is", "mit-liability"]),
    ("ISC", ["copyright?", "isc-grant"]),
    (
        "BSD-3-Clause",
        ["bsd3-ref?", "copyright?", "reserved?", "bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"],
    ),
    ("BSD-2-Clause", ["bsd2-ref?", "copyright?", "reserved?", "bsd-grant", "bsd-source", "bsd-binary"]),
    ("Apache-2.0", ["copyright?", "apache-ref?", "apache-comply", "apache-copy", "apache-as-is", "apache-see"]),
    ("GPL-3.0-or-later", ["copyright?", "gpl-free", "gpl-hope", "gpl-see"]),
    ("MIT", ["mit-ref"]),
    ("BSD-2-Clause", ["bsd2-ref"]),
    ("BSD-3-Clause", ["bsd3-ref"]),
    ("Apache-2.0", ["apache-ref"]),
    ("GPL-3.0-only", ["gpl3-ref"]),
    ("GPL-2.0-only", ["gpl2-ref"]),
    ("LGPL-3.0-only", ["lgpl3-ref"]),
    ("AGPL-3.0-only", ["agpl3-ref"]),
    ("MPL-2.0", ["mpl2-ref"]),
    ("CC-BY-4.0", ["cc-by-ref"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-ref"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-ref"]),
    ("CC0-1.0", ["cc0-ref"]),
    ("all-rights-reserved", ["copyright?", "reserved"]),
]
# Words of which every known sentence has one; texts without any are done. They
# are looked for before sentences are normalised, so what parts words may be a
# line's end, a tab or a comment's lead: whatever becomes a space.
TRIGGERS = (
    "licen[sc]e|licen[sc]ed|permission|copyright|warrant|redistribut|rights[^a-z0-9+]+reserved|liable"
    "|under[^a-z0-9+]|spdx|gnu"
)
COMMENT_LEADS = r"(?m)^[ \t]*[#*;%/-]+[ \t]*"
SENTENCE_ENDS = r"([.!?:;])\s+"
BLANK_LINES = r"\n\s*\n"
# Lines that begin a known sentence, after a title without a full stop.
SENTENCE_STARTS = (
    r"\n\s*(permission |redistribution|licensed under|released under|this |the above |the software |neither "
    r"|in no event |unless |you may |see the |copyright |all rights |spdx|mit license|\d\. )"
)
LEAD = (
    r"^(?:this \w+ is |it is |the \w+ is )?(?:dual )?(?:released|licensed|distributed|available|provided"
    r"|published|made available) under (?:the )?(?:terms of )?(?:the )?"
)
LIST_NUMBER = r"^(?:[a-z0-9] )(?=redistribut|neither )"
SPDX_NAME = r"spdx-license-identifier:[ \t]*([a-z0-9.+-]+)"
MARK = "\x01"


def _identifier(sentence: Column) -> Column:
    """The identifier of a normalised sentence; ``?`` for one that isn't known."""
    known = {text: name for name, texts in SENTENCES.items() for text in texts}
    pairs = [F.lit(x) for item in known.items() for x in item]
    return (
        F.when(sentence.startswith("copyright "), "copyright")
        .when(sentence.startswith("spdx:"), sentence)
        .otherwise(F.coalesce(F.try_element_at(F.create_map(*pairs), sentence), F.lit("?")))
    )


def rule_pattern(names: list[str]) -> str:
    """A rule as a pattern over identifiers, each with a comma before it."""
    return "".join(f"(?:,{n[:-1]})?" if n.endswith("?") else f",{n}" for n in names) + "(?=,)"


def sentence_ids(text: Column) -> Column:
    """Identifiers of all sentences of a text, in order; unknown ones as ``?``."""
    lines = F.regexp_replace(F.lower(text), COMMENT_LEADS, "")
    tagged = F.regexp_replace(lines, SPDX_NAME, MARK + "spdx:$1" + MARK)
    marked = F.regexp_replace(tagged, SENTENCE_ENDS, "$1" + MARK)
    marked = F.regexp_replace(marked, BLANK_LINES, MARK)
    marked = F.regexp_replace(marked, SENTENCE_STARTS, MARK + "$1")

    def normal(s: Column) -> Column:
        plain = F.trim(F.regexp_replace(s, "[^a-z0-9+]+", " "))
        plain = F.regexp_replace(plain, LIST_NUMBER, "")
        return F.when(s.startswith("spdx:"), s).otherwise(F.regexp_replace(plain, LEAD, "under "))

    sentences = F.filter(F.transform(F.split(marked, MARK), normal), lambda s: s != "")
    return F.transform(sentences, _identifier)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, licenses, evidence.

    Sentences of the whole text are normalised and mapped to known identifiers;
    rules are tried in order on the sequence, and what a rule has matched is
    used up. Unknown sentences break a sequence. ``licenses`` has the distinct
    names in order of the text, joined by commas; ``evidence`` is the sequence
    after matching, runs of unknown sentences as one ``?``. A name in an SPDX
    tag counts as it stands, lower-cased.

    Null and empty texts, like texts without a licence, have an empty string in
    both. Repeated rows are scanned each by itself. Extra columns are ignored.
    Only expressions, and no shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    hinted = docs.select(
        F.col(id_col).alias("d"), F.when(F.lower(text).rlike(TRIGGERS), text).alias("t")
    )
    ids = F.concat(F.lit(","), F.array_join(sentence_ids(F.col("t")), ","), F.lit(","))
    sequence = F.regexp_replace(ids, r"(?:,\?)+(?=,)", ",?")
    sequence = F.regexp_replace(sequence, r",spdx:([a-z0-9.+-]+)", ",=$1")
    for name, sentences in RULES:
        sequence = F.regexp_replace(sequence, rule_pattern(sentences), f",={name}")
    found = F.regexp_extract_all(F.col("s"), F.lit(r",=([^,]+)"), F.lit(1))
    names = F.array_join(F.array_distinct(found), ",")
    return hinted.select("d", F.coalesce(sequence, F.lit("")).alias("s")).select(
        F.col("d").alias(id_col),
        names.alias("licenses"),
        F.when(F.col("s").rlike(r"[a-z=]"), F.col("s")).otherwise("").alias("evidence"),
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _duck(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _duck_rules() -> str:
    """The rules over identifiers with a comma on either side of each, so that none need look ahead."""
    out = "'' || list_aggregate(list_transform(ids, lambda i: ',' || i || ','), 'string_agg', '')"
    out = f"regexp_replace({out}, '(?:,[?],)+', ',?,', 'g')"
    out = f"regexp_replace({out}, ',spdx:([a-z0-9.+-]+),', ',=\\1,', 'g')"
    for name, sentences in RULES:
        pattern = "".join(f"(?:,{n[:-1]},)?" if n.endswith("?") else f",{n}," for n in sentences)
        out = f"regexp_replace({out}, '{pattern}', ',={name},', 'g')"
    return out


OP6_SQL = f"""
WITH known AS (SELECT map_from_entries([{", ".join(
    f"('{text}', '{name}')" for name, texts in SENTENCES.items() for text in texts)}]) AS m),
s AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      lower(coalesce(text, '')), {_duck(COMMENT_LEADS)}, '', 'g'),
      {_duck(SPDX_NAME)}, chr(1) || 'spdx:\\1' || chr(1), 'g'),
      {_duck(SENTENCE_ENDS)}, '\\1' || chr(1), 'g'),
      {_duck(BLANK_LINES)}, chr(1), 'g'),
      {_duck(SENTENCE_STARTS)}, chr(1) || '\\1', 'g'), chr(1)) AS parts
  FROM documents),
n AS (
  SELECT r, doc_id, list_filter(list_transform(parts, lambda p: CASE WHEN starts_with(p, 'spdx:') THEN p
    ELSE regexp_replace(regexp_replace(trim(regexp_replace(p, '[^a-z0-9+]+', ' ', 'g')),
      '^[a-z0-9] (redistribut|neither )', '\\1'), {_duck(LEAD)}, 'under ') END), lambda p: p <> '') AS parts
  FROM s),
i AS (
  SELECT r, doc_id, list_transform(parts, lambda p: CASE WHEN starts_with(p, 'copyright ') THEN 'copyright'
    WHEN starts_with(p, 'spdx:') THEN p ELSE coalesce(m[p], '?') END) AS ids
  FROM n, known),
q AS (SELECT doc_id, coalesce({_duck_rules()}, '') AS q FROM i),
e AS (SELECT doc_id, replace(q, ',,', ',') AS s FROM q)
SELECT doc_id,
  CASE WHEN NOT regexp_matches(s, '[a-z=]') THEN '' ELSE array_to_string(list_reduce(list_transform(
    list_prepend('', regexp_extract_all(s, ',=([^,]+)', 1)), lambda x: [x]),
    lambda a, b: CASE WHEN list_contains(a, b[1]) THEN a ELSE a || b END)[2:], ',') END AS licenses,
  CASE WHEN regexp_matches(s, '[a-z=]') THEN s ELSE '' END AS evidence
FROM e
"""
