"""Licence recognition by sentences and rules (DataFrame operations only).

A text is cut into sentences, each is normalised and looked up among known
licence sentences, and the sequence of identifiers found is matched against
ordered rules. A rule takes the identifiers it has matched away, so that the
specific ones, which come first, leave nothing for the general ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What licence sentences say, in lower case, with one space for all that is no letter or digit.
SENTENCES = {
    "MIT_GRANT": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "MIT_NOTICE": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "MIT_AS_IS": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "MIT_LIABILITY": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "MIT_SHORT": "released under the mit license",
    "MIT_SHORT_2": "licensed under the mit license",
    "MIT_SPDX": "spdx license identifier mit",
    "ISC_GRANT": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "BSD_GRANT": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "BSD_SOURCE": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "BSD_BINARY": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "BSD_ENDORSE": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "BSD_AS_IS": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "APACHE_GRANT": "licensed under the apache license version 2 0 the license",
    "APACHE_SHORT": "licensed under the apache license version 2 0",
    "APACHE_COMPLY": "you may not use this file except in compliance with the license",
    "APACHE_GRANT_COMPLY": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "APACHE_COPY": "you may obtain a copy of the license at",
    "APACHE_AS_IS": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "APACHE_SEE": "see the license for the specific language governing permissions and limitations under the license",
    "APACHE_SPDX": "spdx license identifier apache 2 0",
    "GPL_3_GRANT": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "GPL_2_GRANT": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "FREE_SOFTWARE": "this program is free software",
    "GPL_3_TERMS": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "GPL_2_TERMS": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "GPL_WARRANTY": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "GPL_SEE": "see the gnu general public license for more details",
    "GPL_COPY": "you should have received a copy of the gnu general public license along with this program",
    "GPL_3_SHORT": "this work is licensed under the gnu general public license version 3",
    "GPL_3_SHORT_2": "licensed under the gnu general public license version 3",
    "GPL_2_SHORT": "licensed under the gnu general public license version 2",
    "CC_BY_NC_4": "licensed under cc by nc 4 0",
    "CC_BY_4": "licensed under cc by 4 0",
    "CC_BY_SA_4": "licensed under cc by sa 4 0",
    "CC_BY_4_LONG": "this work is licensed under a creative commons attribution 4 0 international license",
    "CC_BY_SA_4_LONG": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "CC_BY_NC_4_LONG": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "MPL_2": "this source code form is subject to the terms of the mozilla public license v 2 0",
}

# Licences in the order in which they are tried; (A)? may be missing, A|B is either.
RULES = [
    ("BSD-3-Clause", "BSD_GRANT BSD_SOURCE BSD_BINARY BSD_ENDORSE (BSD_AS_IS)?"),
    ("BSD-2-Clause", "BSD_GRANT BSD_SOURCE BSD_BINARY (BSD_AS_IS)?"),
    ("MIT", "MIT_GRANT (MIT_NOTICE)? (MIT_AS_IS)? (MIT_LIABILITY)?"),
    ("MIT", "MIT_SHORT|MIT_SHORT_2|MIT_SPDX"),
    ("ISC", "ISC_GRANT"),
    ("Apache-2.0", "APACHE_GRANT_COMPLY (APACHE_COPY)? (APACHE_AS_IS)? (APACHE_SEE)?"),
    ("Apache-2.0", "APACHE_GRANT APACHE_COMPLY (APACHE_COPY)? (APACHE_AS_IS)? (APACHE_SEE)?"),
    ("Apache-2.0", "APACHE_GRANT|APACHE_SHORT|APACHE_SPDX"),
    ("GPL-3.0-or-later", "GPL_3_GRANT (GPL_WARRANTY)? (GPL_SEE)? (GPL_COPY)?"),
    ("GPL-3.0-or-later", "FREE_SOFTWARE GPL_3_TERMS (GPL_WARRANTY)? (GPL_SEE)? (GPL_COPY)?"),
    ("GPL-2.0-or-later", "GPL_2_GRANT (GPL_WARRANTY)? (GPL_SEE)? (GPL_COPY)?"),
    ("GPL-2.0-or-later", "FREE_SOFTWARE GPL_2_TERMS (GPL_WARRANTY)? (GPL_SEE)? (GPL_COPY)?"),
    ("GPL-3.0-only", "GPL_3_SHORT|GPL_3_SHORT_2"),
    ("GPL-2.0-only", "GPL_2_SHORT"),
    ("CC-BY-NC-4.0", "CC_BY_NC_4|CC_BY_NC_4_LONG"),
    ("CC-BY-SA-4.0", "CC_BY_SA_4|CC_BY_SA_4_LONG"),
    ("CC-BY-4.0", "CC_BY_4|CC_BY_4_LONG"),
    ("MPL-2.0", "MPL_2"),
    ("GPL", "GPL_SEE|GPL_COPY"),
]

#: What the SQL doesn't know: more sentences, and such that name somebody (in <>, one to 15 words).
MORE_SENTENCES = {
    "ISC_GRANT_AND": "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "BSD_ADVERT": "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    **{f"{name}_SPDX": f"spdx license identifier {said}" for name, said in (("ISC", "isc"), ("BSD_2", "bsd 2 clause"), ("BSD_3", "bsd 3 clause"), ("BSD_4", "bsd 4 clause"), ("MPL_2", "mpl 2 0"), ("CC_BY_4", "cc by 4 0"), ("CC_BY_SA_4", "cc by sa 4 0"), ("CC_BY_NC_4", "cc by nc 4 0"), ("GPL_2", "gpl 2 0 only"), ("GPL_2_LATER", "gpl 2 0 or later"), ("GPL_3", "gpl 3 0 only"), ("GPL_3_LATER", "gpl 3 0 or later"))},
}
NAMING = {
    "BSD_ENDORSE": "neither the name of <> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "BSD_AS_IS": "this software is provided by <> as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
}
FIRST_RULES = [("BSD-4-Clause", "BSD_GRANT BSD_SOURCE BSD_BINARY BSD_ADVERT BSD_ENDORSE (BSD_AS_IS)?")]
MORE_RULES = [
    ("ISC", "ISC_GRANT_AND|ISC_SPDX"),
    *[(name, f"{said}_SPDX") for name, said in (("BSD-4-Clause", "BSD_4"), ("BSD-3-Clause", "BSD_3"), ("BSD-2-Clause", "BSD_2"), ("GPL-3.0-or-later", "GPL_3_LATER"), ("GPL-2.0-or-later", "GPL_2_LATER"), ("GPL-3.0-only", "GPL_3"), ("GPL-2.0-only", "GPL_2"), ("CC-BY-NC-4.0", "CC_BY_NC_4"), ("CC-BY-SA-4.0", "CC_BY_SA_4"), ("CC-BY-4.0", "CC_BY_4"), ("MPL-2.0", "MPL_2"))],
]

#: Each known sentence has one of these words, so a text without them has none of the sentences.
TRIGGER = r"(?i)licens|software|copyright|redistribut|warrant"
#: Sentences end at these marks before white space, at the text's end and at blank lines; lines are also tried one by one.
SENTENCE_END, LINE_END = r"[.!?:;]+(?:[ \t\r\n]+|\z)|\n[ \t\r]*\n", r"[.!?:;]+(?:[ \t\r\n]+|\z)|[\r\n]+"
NO_WORD = "[^a-z0-9]+"
#: The scan itself cuts nothing off: a known sentence lies between two marks, and marks other than blank lines may lie in it,
#: as in "License-Identifier: MIT", "WARRANTY; without" and "v. 2.0". The three patterns above are those of oracle_sql().
#: A line without a letter or digit is blank, so a comment's empty lines ("#", " *", "//") are, and its leaders are no words.
BLANK, MARK, BETWEEN = r"\n(?:[\p{P}\p{S} \t\r]*\n)+", r"[.!?:;]+(?=[ \t\r\n]|\z)|[\r\n]+", " (?:S )*+"


def rule_pattern(rule: str) -> str:
    """A rule as a pattern over identifiers that are written ;A;B;C; — each with the mark that follows it."""
    parts = []
    for item in rule.split():
        name = item.strip("()?")
        parts.append(f"(?:(?:{name});)" + ("?" if item.endswith("?") else ""))
    return "(?<=;)" + "".join(parts)


def portable_pattern(rule: str) -> str:
    """The same for engines without look-behind: it takes the mark before and gives it back."""
    return ";" + rule_pattern(rule).removeprefix("(?<=;)")


def spoken(said: str) -> str:
    """A known sentence as a pattern over marked(): marks of one paragraph may stand between its words."""
    return said.replace(" ", BETWEEN).replace("<>", f"[a-z0-9]+(?:{BETWEEN}[a-z0-9]+){{0,14}}?")


def marked(text: Column) -> Column:
    """A text in lower case, one space for all that is no letter or digit, S for each sentence or line end, P for each blank line and both ends."""
    paragraphs = F.concat(F.lit("P "), F.regexp_replace(F.lower(text), BLANK, " P "), F.lit(" P"))
    return F.regexp_replace(F.regexp_replace(paragraphs, MARK, " S "), "[^a-z0-9SP]+", " ")


def known_sentences(text: Column) -> Column:
    """The identifiers of a text's known sentences, in order, as ;A;B; (; alone: none)."""
    said = SENTENCES | MORE_SENTENCES
    longest_first = [*NAMING.values(), *sorted(said.values(), key=lambda x: (-len(x), x))]
    found = F.regexp_extract_all(marked(text), F.lit(f"(?<=[SP] )(?:{'|'.join(map(spoken, longest_first))})(?= [SP])"), F.lit(0))
    table = F.create_map(*[F.lit(x) for name, words in said.items() for x in (words, name)])
    naming = lambda s: [F.when(s.rlike(rf"\A{spoken(words)}\z"), F.lit(name)) for name, words in NAMING.items()]
    names = F.transform(found, lambda s: F.coalesce(F.try_element_at(table, F.regexp_replace(s, " S(?= )", "")), *naming(s)))
    return F.concat(F.lit(";"), F.array_join(F.transform(names, lambda s: F.concat(s, F.lit(";"))), ""))


def licence_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, sentence_ids, licences, n_licences.

    sentence_ids are the known sentences in reading order; licences the names of
    the rules that matched, in rule order, each once, both separated by ";" and
    empty where there is none. Sentences may run over line ends and comment
    leaders, but not over blank lines; they begin and end at a line's or a
    sentence's end. A null or empty text has no sentences;
    repeated rows are scanned one by one. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    may = text.rlike(TRIGGER)
    ids = F.when(may, known_sentences(text)).otherwise(F.lit(";"))
    found = docs.select(F.col(id_col).alias("doc_id"), ids.alias("ids")).select("doc_id", "ids", F.col("ids").alias("left"), F.lit("").alias("names"))
    for name, rule in [*FIRST_RULES, *RULES, *MORE_RULES]:
        pattern = portable_pattern(rule)
        hit = F.col("left").rlike(pattern)
        found = found.select(
            "doc_id",
            "ids",
            F.when(hit, F.regexp_replace("left", pattern, ";")).otherwise(F.col("left")).alias("left"),
            F.when(hit & ~F.contains(F.concat(F.lit(";"), "names"), F.lit(f";{name};")), F.concat("names", F.lit(f"{name};"))).otherwise(F.col("names")).alias("names"),
        )
    marks = F.length("names") - F.length(F.replace(F.col("names"), F.lit(";")))
    return found.select("doc_id", F.trim("ids", F.lit(";")).alias("sentence_ids"), F.trim("names", F.lit(";")).alias("licences"), marks.cast("bigint").alias("n_licences"))


def oracle_sql() -> str:
    """A narrower scan in DuckDB's SQL: it cuts at every mark, knows SENTENCES and RULES alone and takes the lines' sentences or the whole text's, not both."""
    said = "MAP {" + ", ".join(f"'{text}': '{name}'" for name, text in SENTENCES.items()) + "}"

    def known(ends: str) -> str:
        pieces = f"string_split_regex(lower(t), '{ends}')"
        plain = f"list_transform({pieces}, lambda s: trim(regexp_replace(s, '{NO_WORD}', ' ', 'g')))"
        ids = f"list_filter(list_transform({plain}, lambda s: {said}[s]), lambda s: s IS NOT NULL)"
        return f"';' || coalesce(array_to_string(list_transform({ids}, lambda s: s || ';'), ''), '')"

    steps = [
        "WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)",
        f"cut AS (SELECT doc_id, CASE WHEN regexp_matches(t, '{TRIGGER}') THEN {known(SENTENCE_END)} ELSE ';' END AS whole, CASE WHEN regexp_matches(t, '{TRIGGER}') THEN {known(LINE_END)} ELSE ';' END AS lines FROM texts)",
        "s0 AS (SELECT doc_id, ids, ids AS rest, '' AS names FROM (SELECT doc_id, CASE WHEN length(whole) - length(replace(whole, ';', '')) >= length(lines) - length(replace(lines, ';', '')) THEN whole ELSE lines END AS ids FROM cut))",
    ]
    for i, (name, rule) in enumerate(RULES):
        pattern = portable_pattern(rule)
        steps.append(
            f"s{i + 1} AS (SELECT doc_id, ids, regexp_replace(rest, '{pattern}', ';', 'g') AS rest,"
            f" CASE WHEN regexp_matches(rest, '{pattern}') AND NOT contains(';' || names, ';{name};') THEN names || '{name};' ELSE names END AS names FROM s{i})"
        )
    return ",\n".join(steps) + f"\nSELECT doc_id, trim(ids, ';') AS sentence_ids, trim(names, ';') AS licences, CAST(length(names) - length(replace(names, ';', '')) AS BIGINT) AS n_licences FROM s{len(RULES)}"
