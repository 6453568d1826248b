"""Licence scans by sentence rules.

A text is cut into sentences, each is normalised and looked up among known
licence sentences; the identifiers found, in order, form a sequence. Licence
rules are tried in a fixed order: a rule that finds its sequence of identifiers
takes them out and names the licence; what no rule takes stays as unmatched.

Sentences end at a line or after ``. ; : ! ?`` and a space; a line that begins
with a small letter, a bracket or one of the capital words inside licence notices
goes on with the sentence before it, and comment marks at the beginning of a line
do not count. An SPDX tag and its expression are one sentence. Normalising keeps ASCII letters and digits
in lower case, with single spaces.

Covered: the notices of Apache-2.0, GPL-2.0 and -3.0, MIT and BSD; sentences that
name one of ``NAMES`` ("This project is licensed under the ..."); the SPDX tags
in ``SPDX``. Full texts of other licences, other wordings, licences outside these
lists, SPDX expressions of several licences and tags such as GPL-2.0 or GPL-2.0+
are not recognised.

Null and empty texts have no sentences. Texts of any length are scanned whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardlake.llm.columns import let

# Licence sentences, normalised, as their published texts have them.
SENTENCES = {
    "APACHE_2_NAME": ("licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license"),
    "APACHE_COMPLIANCE": ("you may not use this file except in compliance with the license",),
    "APACHE_COPY_AT": ("you may obtain a copy of the license at", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    "APACHE_UNLESS": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",),
    "APACHE_SEE": ("see the license for the specific language governing permissions and limitations under the license",),
    "GPL_3_NAME": ("this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3"),
    "GPL_2_NAME": ("this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2"),
    "GPL_3_OR_LATER": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",),
    "GPL_2_OR_LATER": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",),
    "GPL_FREE": ("this program is free software",),
    "GPL_3_TERMS": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",),
    "GPL_2_TERMS": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",),
    # the pieces of the notices that have a semicolon before the version
    "GPL_TERMS": ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",),
    "GPL_3_EITHER": ("either version 3 of the license or at your option any later version",),
    "GPL_2_EITHER": ("either version 2 of the license or at your option any later version",),
    "GPL_HOPE": (
        "this program is distributed in the hope that it will be useful but without any warranty", 
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    "GPL_IMPLIED": ("without even the implied warranty of merchantability or fitness for a particular purpose",),
    "GPL_SEE": ("see the gnu general public license for more details",),
    "MIT_NAME": ("released under the mit license", "licensed under the mit license"),
    "MIT_GRANT": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",),
    "MIT_NOTICE": ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",),
    "AS_IS": ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",),
    "BSD_GRANT": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",),
    "BSD_SOURCE": ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
    "BSD_BINARY": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",),
    "BSD_NAME": ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",),
    "CC_BY_NC_4": ("licensed under cc by nc 4 0",),
    "CC_BY_4": ("licensed under cc by 4 0",),
    "CC_BY_SA_4": ("licensed under cc by sa 4 0",),
    "SPDX_APACHE_2": ("spdx license identifier apache 2 0",),
    "SPDX_MIT": ("spdx license identifier mit",),
    "SPDX_GPL_3": ("spdx license identifier gpl 3 0 only",),
    "ALL_RIGHTS": ("all rights reserved",),
}

#: Every known sentence has one of these words, so a text without them needs no cutting.
CUES = ("licen", "redistribut", "permission", "copyright", "warrant", "rights reserved", "free software")

# Licences by the names under which texts say that something is licensed, normalised.
NAMES = {
    "MIT": ("the mit license",),
    "Apache-2.0": ("the apache license version 2 0", "the apache license 2 0"),
    "BSD-2-Clause": ("the bsd 2 clause license",),
    "BSD-3-Clause": ("the bsd 3 clause license",),
    "ISC": ("the isc license",),
    "MPL-2.0": ("the mozilla public license version 2 0", "the mozilla public license 2 0"),
    **{f"{short}-{version}-only": (f"the gnu {kind} public license version {v}", f"the gnu {kind} public license v{version.replace('.', ' ')}")
       for short, kind, version, v in (("GPL", "general", "2.0", "2"), ("GPL", "general", "3.0", "3"), ("LGPL", "lesser general", "2.1", "2 1"),
                                       ("LGPL", "lesser general", "3.0", "3"), ("AGPL", "affero general", "3.0", "3"))},
    **{f"CC-{part}-4.0": (f"cc {part.replace('-', ' ').lower()} 4 0", f"a creative commons {name} 4 0 international license")
       for part, name in (
           ("BY", "attribution"), ("BY-SA", "attribution sharealike"), ("BY-NC", "attribution noncommercial"), ("BY-ND", "attribution noderivatives"),
           ("BY-NC-SA", "attribution noncommercial sharealike"), ("BY-NC-ND", "attribution noncommercial noderivatives"))},
}
SUBJECTS = ("", *(f"this {what} is " for what in ("project", "software", "file", "work", "program", "library")), "the code is ")
VERBS = ("licensed under", "released under", "distributed under")
#: Tags in full; GPL-2.0 and GPL-2.0+ are the same when normalised, so neither is here.
SPDX = tuple(dict.fromkeys((
    *NAMES, "0BSD", "CC0-1.0", "Unlicense", "BSL-1.0", "Zlib", "EPL-2.0",
    *(f"{x}-{end}" for x in ("GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for end in ("only", "or-later")))))


def _add_names() -> None:
    """Sentences that name a licence, and SPDX tags, as identifiers of their own where none has them yet."""
    taken = {x for texts in SENTENCES.values() for x in texts}
    for licence, names in NAMES.items():
        texts = [f"{subject}{verb} {name}" for subject in SUBJECTS for verb in VERBS for name in names]
        SENTENCES[f"NAME_{licence}"] = tuple(x for x in texts if x not in taken and any(c in x for c in CUES))
    for tag in SPDX:
        text = f"spdx license identifier {tag.lower().replace('-', ' ').replace('.', ' ')}"
        if text not in taken:
            SENTENCES[f"TAG_{tag}"] = (text,)


_add_names()

#: Licence and sequence of identifiers, tried in this order; ``?`` marks one that may be missing.
RULES = (
    ("Apache-2.0", ("APACHE_2_NAME", "APACHE_COMPLIANCE", "APACHE_COPY_AT?", "APACHE_UNLESS?", "APACHE_SEE?")),
    ("Apache-2.0", ("APACHE_2_NAME",)),
    ("GPL-3.0-or-later", ("GPL_3_OR_LATER", "GPL_HOPE?", "GPL_IMPLIED?", "GPL_SEE?")),
    ("GPL-3.0-or-later", ("GPL_FREE?", "GPL_3_TERMS", "GPL_HOPE?", "GPL_IMPLIED?", "GPL_SEE?")),
    ("GPL-2.0-or-later", ("GPL_2_OR_LATER", "GPL_HOPE?", "GPL_IMPLIED?", "GPL_SEE?")),
    ("GPL-2.0-or-later", ("GPL_FREE?", "GPL_2_TERMS", "GPL_HOPE?", "GPL_IMPLIED?", "GPL_SEE?")),
    ("GPL-3.0-or-later", ("GPL_FREE?", "GPL_TERMS", "GPL_3_EITHER", "GPL_HOPE?", "GPL_IMPLIED?", "GPL_SEE?")),
    ("GPL-2.0-or-later", ("GPL_FREE?", "GPL_TERMS", "GPL_2_EITHER", "GPL_HOPE?", "GPL_IMPLIED?", "GPL_SEE?")),
    ("GPL-3.0-only", ("GPL_3_NAME",)),
    ("GPL-2.0-only", ("GPL_2_NAME",)),
    ("MIT", ("MIT_NAME?", "MIT_GRANT", "MIT_NOTICE", "AS_IS?")),
    ("MIT", ("MIT_NAME",)),
    ("BSD-3-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_NAME")),
    ("BSD-2-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY")),
    ("CC-BY-NC-4.0", ("CC_BY_NC_4",)),
    ("CC-BY-SA-4.0", ("CC_BY_SA_4",)),
    ("CC-BY-4.0", ("CC_BY_4",)),
    ("Apache-2.0", ("SPDX_APACHE_2",)),
    ("MIT", ("SPDX_MIT",)),
    ("GPL-3.0-only", ("SPDX_GPL_3",)),
    *((x, (f"NAME_{x}",)) for x in NAMES),
    *((x.removeprefix("TAG_"), (x,)) for x in SENTENCES if x.startswith("TAG_")),
    ("Proprietary", ("ALL_RIGHTS",)),
)

COMMENT = r"(?m)^[ \t]*(?:#|//|\*|;|--|%)+[ \t]?"
# Words with capitals that can begin a line inside a known sentence.
_INSIDE = (
    "GNU", "General Public", "Public License", "License", "Licenses", "Free Software", "Software", "Foundation", "Apache", "Version", "BASIS", "AS", "IS",
    "WITHOUT", "WARRANTIES", "WARRANTY", "THE WARRANTIES", "CONDITIONS", "OR", "OF", "ANY", "KIND", "EXPRESS", "IMPLIED", "INCLUDING", "BUT", "NOT", "LIMITED",
    "TO", "SOFTWARE", "PROVIDED", "MERCHANTABILITY", "FITNESS", "FOR", "A", "PARTICULAR", "PURPOSE", "AND", "NONINFRINGEMENT")
WRAPPED = rf"\n[ \t]*([a-z(]|[\"'“]?(?:{'|'.join(_INSIDE)})\b)"
_SPDX_ID = r"\(*[A-Za-z0-9.+\-]+\)*"
ENDS = rf"((?i:SPDX-License-Identifier):[ \t]*{_SPDX_ID}(?:[ \t]+(?:AND|OR|WITH)[ \t]+{_SPDX_ID})*|[.;:!?][ \t])[ \t]*"


def known() -> dict[str, str]:
    """Identifier by normalised sentence."""
    out = {s: name for name, texts in SENTENCES.items() for s in texts}
    if bad := [s for s in out if not any(c in s for c in CUES)]:
        raise ValueError(f"sentences without a cue: {bad}")
    return out


def rule_pattern(sequence: tuple[str, ...]) -> str:
    """A regular expression over identifiers that each end in a comma and follow a comma.

    At least one identifier of a rule is not optional.
    """
    return "".join(f"(?:{s[:-1]},)?" if s.endswith("?") else f"{s}," for s in sequence)


def sentences(text: Column) -> Column:
    """The normalised sentences of a text, in order; empty ones are left out."""
    cut = F.regexp_replace(text, COMMENT, "")
    cut = F.regexp_replace(F.regexp_replace(cut, WRAPPED, " $1"), ENDS, "$1\n")
    normal = F.transform(F.split(cut, "\n"), lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")))
    return F.filter(normal, lambda s: s != "")


def identifiers(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    table = F.create_map(*[F.lit(x) for pair in known().items() for x in pair])
    cued = F.lower(text).rlike("|".join(CUES))
    found = let(table, lambda t: F.filter(F.transform(sentences(text), lambda s: t[s]), lambda i: i.isNotNull()))
    return F.when(cued, found).otherwise(F.array().cast("array<string>"))


def match_rules(ids: Column) -> Column:
    """``licenses``, in the order of the rules and without repeats, and the ``unmatched`` identifiers."""
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("," + rule_pattern(seq)).alias("pattern")) for name, seq in RULES])
    start = F.struct(
        F.concat(F.lit(","), F.array_join(ids, ","), F.lit(",")).alias("rest"), F.array().cast("array<string>").alias("licenses"))

    def step(acc: Column, r: Column) -> Column:
        # the sequence is written ",A,B,"; a rule matches "A,B," after a comma, which stays
        return F.when(F.regexp_like(acc["rest"], r["pattern"]), F.struct(
            F.regexp_replace(acc["rest"], r["pattern"], F.lit(",")).alias("rest"),
            F.array_append(acc["licenses"], r["name"]).alias("licenses"))).otherwise(acc)

    return F.aggregate(rules, start, step, lambda acc: F.struct(
        F.array_distinct(acc["licenses"]).alias("licenses"),
        F.filter(F.split(acc["rest"], ","), lambda x: x != "").alias("unmatched")))


def scan(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, ``sentence_ids``, ``licenses`` and ``unmatched`` as arrays, a row per row of ``docs``. A projection; no shuffle."""
    found = docs.select(*[F.col(k) for k in keys], identifiers(F.coalesce(F.col(text), F.lit(""))).alias("__ids"))
    matched = found.withColumn("__m", F.when(F.size("__ids") > 0, match_rules(F.col("__ids"))))
    none = F.array().cast("array<string>")
    return matched.select(*keys, F.col("__ids").alias("sentence_ids"), F.coalesce("__m.licenses", none).alias("licenses"),
                          F.coalesce("__m.unmatched", none).alias("unmatched"))


def scan_sql(table: str = "documents") -> str:
    """The same scan in DuckDB's SQL, with the lists as text."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(s)}, {quote(i)})" for s, i in known().items())
    cut = f"regexp_replace(coalesce(text, ''), {quote(COMMENT)}, '', 'g')"
    cut = f"regexp_replace({cut}, {quote(WRAPPED)}, ' \\1', 'g')"
    cut = f"regexp_replace({cut}, {quote(ENDS)}, '\\1' || chr(10), 'g')"
    steps, last = [], "seq"
    for k, (name, sequence) in enumerate(RULES):
        pattern = quote("," + rule_pattern(sequence))
        steps.append(f"s{k} AS (SELECT r, doc_id, ids, regexp_replace(rest, {pattern}, ',', 'g') AS rest, "
                     f"CASE WHEN regexp_matches(rest, {pattern}) AND NOT list_contains(found, {quote(name)}) "
                     f"THEN list_append(found, {quote(name)}) ELSE found END AS found FROM {last})")
        last = f"s{k}"
    return f"""
WITH known(sentence, id) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
s AS (SELECT r, unnest(range(1, len(parts) + 1)) AS pos, unnest(parts) AS part FROM (SELECT r, string_split({cut}, chr(10)) AS parts FROM d)),
n AS (SELECT r, pos, trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')) AS sentence FROM s),
i AS (SELECT r, list(id ORDER BY pos) AS l FROM n JOIN known USING (sentence) GROUP BY r),
seq AS (SELECT d.r, doc_id, coalesce(l, []) AS ids, ',' || coalesce(array_to_string(l, ','), '') || ',' AS rest, CAST([] AS VARCHAR[]) AS found
  FROM d LEFT JOIN i USING (r)),
{", ".join(steps)}
SELECT doc_id, array_to_string(ids, ',') AS sentence_ids, array_to_string(found, ',') AS licenses,
  array_to_string(list_filter(string_split(rest, ','), lambda x: x <> ''), ',') AS unmatched FROM {last}
""".replace("FROM documents", f"FROM {table}")
