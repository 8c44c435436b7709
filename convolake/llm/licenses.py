"""Operator 10: licence recognition by sentence rules.

A text is normalised (lower case, runs of anything but letters and digits as one blank, so comment leaders vanish) with
its boundaries kept: hard ones after . ! ? and at lines without letters and digits, soft ones at other line ends. A known
licence sentence is found where it stands between two boundaries; inside it, soft boundaries count as blanks, so wrapped
sentences are found as well as one-line titles. The leftmost and then longest sentence holds. The sequence of identifiers
found is matched against ordered rules: a rule holds if its identifiers occur in that order. Everything is DataFrame
expressions over one scan; nothing is shuffled.

Defined results: a null or empty text, or one without known sentences, has empty lists; a sentence that occurs again
counts again in the sequence, and a rule is reported once; further columns of the input are ignored. ORACLE knows
SENTENCES and RULES and one-line sentences only: it gives the same rows where no text has a wrapped or a further one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convolake.llm.common import bind, table

#: Known licence sentences (normalised: lower case, runs of anything but letters and digits as one blank). Fixed values.
SENTENCES: dict[str, str] = {
    "released under the mit license": "mit.ref",
    "licensed under the mit license": "mit.ref",
    "this project is licensed under the mit license": "mit.ref",
    "spdx license identifier mit": "mit.ref",
    "the mit license mit": "mit.title",
    "mit license": "mit.title",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit.notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit.warranty",
    "licensed under the apache license version 2 0": "apache2.ref",
    "licensed under the apache license version 2 0 the license": "apache2.ref",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache2.grant",
    "you may obtain a copy of the license at": "apache2.copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache2.warranty",
    "see the license for the specific language governing permissions and limitations under the license": "apache2.see",
    "spdx license identifier apache 2 0": "apache2.ref",
    "apache license": "apache2.title",
    "version 2 0 january 2004": "apache2.version",
    "this work is licensed under the gnu general public license version 3": "gpl3.ref",
    "licensed under the gnu general public license version 3": "gpl3.ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3.grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2.grant",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl.warranty",
    "see the gnu general public license for more details": "gpl.see",
    "licensed under cc by nc 4 0": "ccbync4.ref",
    "licensed under cc by 4 0": "ccby4.ref",
    "licensed under cc by sa 4 0": "ccbysa4.ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccby4.ref",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd.source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd.binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd.names",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2.ref",
    "all rights reserved": "rights",
}

#: Licence rules: identifiers that must occur in this order. More specific rules stand first.
RULES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("mit.full", "MIT", ("mit.notice", "mit.warranty")),
    ("mit.title", "MIT", ("mit.title",)),
    ("mit.ref", "MIT", ("mit.ref",)),
    ("apache2.header", "Apache-2.0", ("apache2.grant", "apache2.copy", "apache2.warranty", "apache2.see")),
    ("apache2.title", "Apache-2.0", ("apache2.title", "apache2.version")),
    ("apache2.grant", "Apache-2.0", ("apache2.grant",)),
    ("apache2.ref", "Apache-2.0", ("apache2.ref",)),
    ("gpl3.header", "GPL-3.0-or-later", ("gpl3.grant", "gpl.warranty", "gpl.see")),
    ("gpl3.ref", "GPL-3.0-only", ("gpl3.ref",)),
    ("gpl2.header", "GPL-2.0-or-later", ("gpl2.grant", "gpl.warranty", "gpl.see")),
    ("bsd3", "BSD-3-Clause", ("bsd.source", "bsd.binary", "bsd.names")),
    ("bsd2", "BSD-2-Clause", ("bsd.source", "bsd.binary")),
    ("mpl2.ref", "MPL-2.0", ("mpl2.ref",)),
    ("ccbync4.ref", "CC-BY-NC-4.0", ("ccbync4.ref",)),
    ("ccbysa4.ref", "CC-BY-SA-4.0", ("ccbysa4.ref",)),
    ("ccby4.ref", "CC-BY-4.0", ("ccby4.ref",)),
)

_FREE = "this {} is free software you can redistribute it and or modify it under the terms of the gnu {}general public license "
_FSF = "as published by the free software foundation "
_LATER = "either version {} of the license or at your option any later version"


def _gnu() -> dict[str, str]:
    """The grants of the GNU licences, by what they call the work."""
    out: dict[str, str] = {}
    for work in ("program", "library", "software", "file"):
        for kind, name, versions in (("", "gpl", ("2", "3")), ("lesser ", "lgpl", ("2 1", "3")), ("library ", "lgpl", ("2",)), ("affero ", "agpl", ("3",))):
            for v in versions:
                start, i = _FREE.format(work, kind), name + v.replace(" ", "")
                out[start + _FSF + _LATER.format(v)] = f"{i}.grant"
                out[start + _FSF + f"version {v} of the license"] = out[start + f"version {v} " + _FSF.strip()] = f"{i}.only"
        for kind, name in (("lesser ", "lgpl"), ("library ", "lgpl"), ("affero ", "agpl")):
            out[f"see the gnu {kind}general public license for more details"] = f"{name}.see"
        out[f"this {work} is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"] = "gpl.warranty"
    return out


_SPDX = {
    "isc": "ISC", "0bsd": "0BSD", "bsd 2 clause": "BSD-2-Clause", "bsd 3 clause": "BSD-3-Clause", "mpl 2 0": "MPL-2.0", "epl 1 0": "EPL-1.0", "epl 2 0": "EPL-2.0", "unlicense": "Unlicense", "zlib": "Zlib", "bsl 1 0": "BSL-1.0", "cc0 1 0": "CC0-1.0",
    **{f"{k} {v.replace('.', ' ')} {w.replace('-', ' ')}": f"{k.upper()}-{v}-{w}" for k, v in (("gpl", "2.0"), ("gpl", "3.0"), ("lgpl", "2.1"), ("lgpl", "3.0"), ("agpl", "3.0")) for w in ("only", "or-later")},
}

#: Further sentences that only the operator knows.
FURTHER_SENTENCES: dict[str, str] = _gnu() | {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit.grant",
    "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software": "mit.notice",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit.liability",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache2.copy",
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "apache2.copy",
    "gnu general public license": "gpl.title",
    "gnu lesser general public license": "lgpl.title",
    "gnu affero general public license": "agpl.title",
    "version 2 june 1991": "gpl2.version",
    "version 3 29 june 2007": "gpl3.version",
    "version 2 1 february 1999": "lgpl21.version",
    "version 3 19 november 2007": "agpl3.version",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd.grant",
    "all advertising materials mentioning features or use of this software must display the following acknowledgement": "bsd.advert",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd.warranty",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc.grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc.grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd.grant",
    "isc license": "isc.title",
    "eclipse public license v 1 0": "epl1.title",
    "eclipse public license v 2 0": "epl2.title",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html": "epl1.grant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl2.grant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at http www eclipse org legal epl 2 0": "epl2.grant",
    "mozilla public license version 2 0": "mpl2.title",
    "this is free and unencumbered software released into the public domain": "unlicense.grant",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib.grant",
    "boost software license version 1 0 august 17th 2003": "bsl1.title",
    **{f"spdx license identifier {x}": f"spdx.{x.replace(' ', '-')}" for x in _SPDX},
}

FURTHER_RULES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("mit.grant", "MIT", ("mit.grant",)),
    ("gpl3.grant", "GPL-3.0-or-later", ("gpl3.grant",)),
    ("gpl3.only", "GPL-3.0-only", ("gpl3.only",)),
    ("gpl3.title", "GPL-3.0-only", ("gpl.title", "gpl3.version")),
    ("gpl2.grant", "GPL-2.0-or-later", ("gpl2.grant",)),
    ("gpl2.only", "GPL-2.0-only", ("gpl2.only",)),
    ("gpl2.title", "GPL-2.0-only", ("gpl.title", "gpl2.version")),
    ("lgpl3.grant", "LGPL-3.0-or-later", ("lgpl3.grant",)),
    ("lgpl3.only", "LGPL-3.0-only", ("lgpl3.only",)),
    ("lgpl3.title", "LGPL-3.0-only", ("lgpl.title", "gpl3.version")),
    ("lgpl21.grant", "LGPL-2.1-or-later", ("lgpl21.grant",)),
    ("lgpl21.only", "LGPL-2.1-only", ("lgpl21.only",)),
    ("lgpl21.title", "LGPL-2.1-only", ("lgpl.title", "lgpl21.version")),
    ("lgpl2.grant", "LGPL-2.0-or-later", ("lgpl2.grant",)),
    ("lgpl2.only", "LGPL-2.0-only", ("lgpl2.only",)),
    ("agpl3.grant", "AGPL-3.0-or-later", ("agpl3.grant",)),
    ("agpl3.only", "AGPL-3.0-only", ("agpl3.only",)),
    ("agpl3.title", "AGPL-3.0-only", ("agpl.title", "agpl3.version")),
    ("bsd4", "BSD-4-Clause", ("bsd.source", "bsd.binary", "bsd.advert")),
    ("isc.grant", "ISC", ("isc.grant",)),
    ("isc.title", "ISC", ("isc.title",)),
    ("0bsd.grant", "0BSD", ("0bsd.grant",)),
    ("epl2.grant", "EPL-2.0", ("epl2.grant",)),
    ("epl2.title", "EPL-2.0", ("epl2.title",)),
    ("epl1.grant", "EPL-1.0", ("epl1.grant",)),
    ("epl1.title", "EPL-1.0", ("epl1.title",)),
    ("mpl2.title", "MPL-2.0", ("mpl2.title",)),
    ("unlicense.grant", "Unlicense", ("unlicense.grant",)),
    ("zlib.grant", "Zlib", ("zlib.grant",)),
    ("bsl1.title", "BSL-1.0", ("bsl1.title",)),
    *((f"spdx.{x.replace(' ', '-')}", lic, (f"spdx.{x.replace(' ', '-')}",)) for x, lic in _SPDX.items()),
)

KNOWN_SENTENCES, KNOWN_RULES = FURTHER_SENTENCES | SENTENCES, RULES + FURTHER_RULES


def sentences_of(text: Column) -> Column:
    """The normalised sentences of a text, in order."""
    cut = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"([.!?])[ \t]+", "$1\n"), "\n")
    return F.transform(cut, lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")))


def bounded(text: Column) -> Column:
    """The normalised text with H for its hard and S for its soft boundaries (no capital is left in it otherwise)."""
    t = F.lower(F.concat(F.lit("\n"), F.coalesce(text, F.lit("")), F.lit("\n")))
    t = F.regexp_replace(t, r"\bv\.(?=[^a-z0-9]{1,40}[0-9])", "v")  # "v. 2.0" goes on
    t = F.regexp_replace(t, r"(\n[^a-z0-9\n]*+(?:[0-9]{1,2}|[a-z]{1,3}))\)(?=[ \t])", "$1H")  # marks of a list: a) (1)
    t = F.regexp_replace(t, r"[.!?](?=[ \t\r\n])", "H")
    t = F.regexp_replace(t, r"\n[^a-z0-9\n]*+\n[^a-z0-9]*+", "H")
    t = F.regexp_replace(F.translate(t, "\n", "S"), "[^a-z0-9HS]+", " ")
    t = F.regexp_replace(F.regexp_replace(t, "[ HS]*H[ HS]*+", "H"), " ?S ?", "S")
    # the name of an organisation stands for the copyright holder
    return F.regexp_replace(t, r"(?<=[HS])neither[ S]the[ S]names?[ S]of(?:[ S][a-z0-9]{1,40}){1,20}?[ S]nor[ S]the[ S]names[ S]of[ S](?:its|their|any)[ S]contributors(?=[ S])", "neither the name of the copyright holder nor the names of its contributors")


def license_scan(docs: DataFrame, sentences: dict[str, str] = KNOWN_SENTENCES, rules=KNOWN_RULES) -> DataFrame:
    """doc_id, sentence_ids (in order), rules and licenses (both in the order of the rules) of each document."""
    known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    either = "|".join(s.replace(" ", "[ S]") for s in sorted(sentences, key=lambda s: (-len(s), s)))
    spans = F.regexp_extract_all(bounded(F.col("text")), F.lit(f"(?<=[HS])(?:{either})(?=[HS])"), F.lit(0))
    found = F.transform(spans, lambda s: F.element_at(known, F.translate(s, "S", " ")))
    d = docs.select("doc_id", found.alias("sentence_ids"))
    chain = F.concat(F.lit(","), F.array_join("sentence_ids", ","), F.lit(","))
    d = d.withColumn("chain", chain)
    pattern = lambda ids: "(,.*)?".join("," + i.replace(".", r"\.") + "(?=,)" for i in ids)
    hits = F.array_compact(F.array(*[F.when(F.col("chain").rlike(pattern(ids)), F.struct(F.lit(rule).alias("rule"), F.lit(lic).alias("license"))) for rule, lic, ids in rules]))
    d = d.select("doc_id", "sentence_ids", bind(hits, lambda h: h).alias("hits"))
    return d.select(
        "doc_id", "sentence_ids", F.transform("hits", lambda x: x["rule"]).alias("rules"), F.array_distinct(F.transform("hits", lambda x: x["license"])).alias("licenses")
    )


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = license_scan(table(spark, sf_dir, "documents"))
    return d.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("rules", ",").alias("rules"),
        F.array_join("licenses", ",").alias("licenses"),
    )


def _oracle() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({q(s)}, {q(i)})" for s, i in SENTENCES.items())
    holds = lambda ids: " AND ".join(
        [f"list_contains(ids, {q(ids[0])})"] if len(ids) == 1 else [f"regexp_matches(chain, {q(',(.*,)?'.join(ids))})"]
    )
    hit = ", ".join(f"CASE WHEN {holds(ids)} THEN {q(r)} END" for r, _, ids in RULES)
    lic = ", ".join(f"CASE WHEN {holds(ids)} THEN {q(x)} END" for _, x, ids in RULES)
    return rf"""
WITH known(s, id) AS (VALUES {known}),
cut AS (SELECT doc_id, unnest(list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?])[ \t]+', E'\\1\n', 'g'), chr(10)),
          lambda x: trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g')))) AS s,
        generate_subscripts(string_split(regexp_replace(coalesce(text, ''), '([.!?])[ \t]+', E'\\1\n', 'g'), chr(10)), 1) AS i FROM documents),
hits AS (SELECT doc_id, list(id ORDER BY i) AS ids FROM cut JOIN known USING (s) GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(ids, CAST([] AS VARCHAR[])) AS ids FROM documents LEFT JOIN hits USING (doc_id)),
e AS (SELECT *, ',' || array_to_string(ids, ',') || ',' AS chain FROM d)
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
       array_to_string(list_filter([{hit}], lambda x: x IS NOT NULL), ',') AS rules,
       array_to_string((SELECT list_distinct_keep FROM (SELECT list_filter([{lic}], lambda x, i: x IS NOT NULL AND NOT list_contains(([{lic}])[:i-1], x)) AS list_distinct_keep)), ',') AS licenses
FROM e
"""


ORACLE = _oracle()
