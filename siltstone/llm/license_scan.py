r"""Licence recognition by sentence rules; DataFrame and SQL functions only.

Comment marks at line starts are taken off. A text is broken after ``. ! ?`` and white space, at blank lines, after a colon
that ends a line, around SPDX tags, and at line breaks before a line that starts like a known sentence; ``v. 2`` and ``at``
before an address are kept together. Each sentence is normalised (A-Z in lower case, whatever is not a-z or 0-9 as one
space) and looked up in the table of known sentences, or, if it says that something is licensed (released, distributed ...)
under something, in the table of licence names. What is left is the sequence of their identifiers. Rules are sequences of
identifiers and are tried in order: one that is found names its licence and uses up its identifiers, which leave a mark, so
that what stood on both sides of them does not become neighbours. Everything is one pass over the text inside its row;
nothing is shuffled.

Defined cases: a null or empty text has no sentences; a text of any length is read whole. Rows that repeat, or have no id,
are scanned one by one. Where several rules fit (ties), the first in order wins; a licence that is found twice is named
once. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import UPPER, ascii_lower, table

# Known sentences of licence texts and notices, normalised as above, by identifier.
SENTENCES = {
    "MitPermission": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "MitNotice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "MitWarranty": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "ApacheComply": ["you may not use this file except in compliance with the license"],
    "ApacheObtain": ["you may obtain a copy of the license at http www apache org licenses license 2 0", "you may obtain a copy of the license at https www apache org licenses license 2 0"],
    "ApacheWarranty": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "ApacheSee": ["see the license for the specific language governing permissions and limitations under the license"],
    "Gpl3Later": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "Gpl2Later": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "GplWarranty": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "GplSee": ["see the gnu general public license for more details"],
    "AgplLater": ["this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "AgplSee": ["see the gnu affero general public license for more details"],
    "Lgpl21Later": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"],
    "Lgpl3Later": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "MplRef": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "BsdPermit": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "BsdSource": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "BsdBinary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "BsdNames": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "BsdWarranty": ["this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"],
    "IscPermission": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "ZlibWarranty": ["this software is provided as is without any express or implied warranty"],
    "ZlibPermission": ["permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"],
    "BoostPermission": ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following"],
    "UnlicenseRef": ["this is free and unencumbered software released into the public domain"],
    "Cc0Ref": ["to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide"],
    "SpdxMit": ["spdx license identifier mit"],
    "SpdxApache": ["spdx license identifier apache 2 0"],
    "SpdxEither": ["spdx license identifier mit or apache 2 0", "spdx license identifier apache 2 0 or mit"],
    "SpdxGpl3": ["spdx license identifier gpl 3 0", "spdx license identifier gpl 3 0 only"],
    "SpdxGpl3Later": ["spdx license identifier gpl 3 0 or later"],
    "SpdxGpl2": ["spdx license identifier gpl 2 0", "spdx license identifier gpl 2 0 only"],
    "SpdxGpl2Later": ["spdx license identifier gpl 2 0 or later"],
    "SpdxLgpl21": ["spdx license identifier lgpl 2 1", "spdx license identifier lgpl 2 1 only", "spdx license identifier lgpl 2 1 or later"],
    "SpdxLgpl3": ["spdx license identifier lgpl 3 0", "spdx license identifier lgpl 3 0 only", "spdx license identifier lgpl 3 0 or later"],
    "SpdxAgpl3": ["spdx license identifier agpl 3 0", "spdx license identifier agpl 3 0 only", "spdx license identifier agpl 3 0 or later"],
    "SpdxMpl": ["spdx license identifier mpl 2 0"],
    "SpdxBsd2": ["spdx license identifier bsd 2 clause"],
    "SpdxBsd3": ["spdx license identifier bsd 3 clause"],
    "SpdxIsc": ["spdx license identifier isc"],
    "SpdxEpl": ["spdx license identifier epl 2 0"],
    "SpdxCc0": ["spdx license identifier cc0 1 0"],
    "SpdxUnlicense": ["spdx license identifier unlicense"],
    "SpdxZlib": ["spdx license identifier zlib"],
    "SpdxBoost": ["spdx license identifier bsl 1 0"],
    "SpdxCcBy": ["spdx license identifier cc by 4 0"],
    "Rights": ["all rights reserved"],
}
# Names of licences, normalised, as they stand after "licensed under the", by identifier.
NAMES = {
    "MitRef": ["mit license", "mit licence", "mit"],
    "ApacheRef": ["apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache 2 0", "apache license v2 0"],
    "Gpl3Ref": ["gnu general public license version 3", "gnu general public license v3", "gnu gpl v3", "gplv3", "gpl v3", "gpl version 3"],
    "Gpl2Ref": ["gnu general public license version 2", "gnu general public license v2", "gnu gpl v2", "gplv2", "gpl v2", "gpl version 2"],
    "Agpl3Ref": ["gnu affero general public license version 3", "gnu affero general public license v3", "agplv3", "agpl v3"],
    "Lgpl3Ref": ["gnu lesser general public license version 3", "gnu lesser general public license v3", "lgplv3", "lgpl v3"],
    "Lgpl21Ref": ["gnu lesser general public license version 2 1", "gnu lesser general public license v2 1", "lgplv2 1", "lgpl v2 1"],
    "MplRef": ["mozilla public license version 2 0", "mozilla public license v 2 0", "mozilla public license 2 0", "mpl 2 0"],
    "Bsd3Ref": ["bsd 3 clause license", "3 clause bsd license", "new bsd license"],
    "Bsd2Ref": ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license"],
    "BsdRef": ["bsd license", "bsd style license"],
    "IscRef": ["isc license"],
    "EplRef": ["eclipse public license 2 0", "eclipse public license v 2 0", "eclipse public license version 2 0"],
    "Cc0Ref": ["cc0 1 0", "cc0 1 0 universal", "creative commons zero v1 0 universal license"],
    "UnlicenseRef": ["unlicense"],
    "ZlibRef": ["zlib license"],
    "BoostRef": ["boost software license version 1 0", "boost software license 1 0"],
    "CcByRef": ["cc by 4 0", "creative commons attribution 4 0 international license"],
    "CcBySaRef": ["cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"],
    "CcByNcRef": ["cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"],
}
# Licence and the sequence of sentence identifiers that states it, in the order in which they are tried.
RULES = [
    ("MIT", ["MitPermission", "MitNotice", "MitWarranty"]),
    ("Apache-2.0", ["ApacheRef", "ApacheComply", "ApacheObtain", "ApacheWarranty", "ApacheSee"]),
    ("AGPL-3.0-or-later", ["AgplLater", "GplWarranty", "AgplSee"]),
    ("GPL-3.0-or-later", ["Gpl3Later", "GplWarranty", "GplSee"]),
    ("GPL-2.0-or-later", ["Gpl2Later", "GplWarranty", "GplSee"]),
    ("BSD-3-Clause", ["BsdPermit", "BsdSource", "BsdBinary", "BsdNames", "BsdWarranty"]),
    ("BSD-3-Clause", ["BsdPermit", "BsdSource", "BsdBinary", "BsdNames"]),
    ("BSD-2-Clause", ["BsdPermit", "BsdSource", "BsdBinary", "BsdWarranty"]),
    ("BSD-2-Clause", ["BsdPermit", "BsdSource", "BsdBinary"]),
    ("Zlib", ["ZlibWarranty", "ZlibPermission"]),
    ("MIT", ["MitPermission", "MitNotice"]),
    ("Apache-2.0", ["ApacheRef", "ApacheComply"]),
    ("MIT", ["MitRef"]),
    ("Apache-2.0", ["ApacheRef"]),
    ("AGPL-3.0-or-later", ["AgplLater"]),
    ("GPL-3.0-or-later", ["Gpl3Later"]),
    ("GPL-2.0-or-later", ["Gpl2Later"]),
    ("LGPL-2.1-or-later", ["Lgpl21Later"]),
    ("LGPL-3.0-or-later", ["Lgpl3Later"]),
    ("GPL-3.0", ["Gpl3Ref"]),
    ("GPL-2.0", ["Gpl2Ref"]),
    ("AGPL-3.0", ["Agpl3Ref"]),
    ("LGPL-3.0", ["Lgpl3Ref"]),
    ("LGPL-2.1", ["Lgpl21Ref"]),
    ("MPL-2.0", ["MplRef"]),
    ("BSD-3-Clause", ["Bsd3Ref"]),
    ("BSD-2-Clause", ["Bsd2Ref"]),
    ("BSD-style", ["BsdRef"]),
    ("BSD-style", ["BsdPermit"]),
    ("ISC", ["IscPermission"]),
    ("ISC", ["IscRef"]),
    ("EPL-2.0", ["EplRef"]),
    ("CC0-1.0", ["Cc0Ref"]),
    ("Unlicense", ["UnlicenseRef"]),
    ("Zlib", ["ZlibPermission"]),
    ("Zlib", ["ZlibRef"]),
    ("BSL-1.0", ["BoostPermission"]),
    ("BSL-1.0", ["BoostRef"]),
    ("CC-BY-NC-4.0", ["CcByNcRef"]),
    ("CC-BY-SA-4.0", ["CcBySaRef"]),
    ("CC-BY-4.0", ["CcByRef"]),
    ("MIT", ["SpdxMit"]),
    ("Apache-2.0", ["SpdxApache"]),
    ("MIT OR Apache-2.0", ["SpdxEither"]),
    ("GPL-3.0", ["SpdxGpl3"]),
    ("GPL-3.0-or-later", ["SpdxGpl3Later"]),
    ("GPL-2.0", ["SpdxGpl2"]),
    ("GPL-2.0-or-later", ["SpdxGpl2Later"]),
    ("LGPL-2.1", ["SpdxLgpl21"]),
    ("LGPL-3.0", ["SpdxLgpl3"]),
    ("AGPL-3.0", ["SpdxAgpl3"]),
    ("MPL-2.0", ["SpdxMpl"]),
    ("BSD-2-Clause", ["SpdxBsd2"]),
    ("BSD-3-Clause", ["SpdxBsd3"]),
    ("ISC", ["SpdxIsc"]),
    ("EPL-2.0", ["SpdxEpl"]),
    ("CC0-1.0", ["SpdxCc0"]),
    ("Unlicense", ["SpdxUnlicense"]),
    ("Zlib", ["SpdxZlib"]),
    ("BSL-1.0", ["SpdxBoost"]),
    ("CC-BY-4.0", ["SpdxCcBy"]),
]
#: Every known sentence has one of these, so that a text without them needs no closer look.
CUES = "licen|copyright|permission|redistribut|warrant|rights reserved|public domain|(?:released|distributed|available|provided|published)[^a-z0-9]+under"
BREAK, MARK = "\x01", "|"
#: What is licensed, and how; then the name of the licence, and what may come after the name.
UNDER = "^(?:.* )?(?:licensed|released|distributed|available|provided|published) under (?:the terms of )?(?:the |an? )?(.+)$"
AFTER = " (?:the license|see|which|you may|for details|for more)(?: .*)?$"
#: Sentences begin with one of these at the start of a line, whatever ends the line before.
STARTS = sorted({s.split()[0].capitalize() for v in SENTENCES.values() for s in v} - {"Spdx"} | {"Licensed", "Released", "Distributed"})
#: (pattern, what comes instead), one after another; \1 and \2 are groups.
STEPS = [
    (r"(\A|\n)[ \t]*(?:/\*+|\*+/|//+|#+|\*+|--+|;+|%+|<!--|>+)[ \t]*", r"\1"),
    (r"\b([vV])\.[ \t]+([0-9])", r"\1 \2"),
    (r"\b(at):?[ \t\r\n\f]+(https?://)", r"\1 \2"),
    (r"([sS][pP][dD][xX]-[lL]icense-[iI]dentifier:[^\n*]*)", BREAK + r"\1" + BREAK),
    (r"[.!?][ \t\r\n\f]+|:[ \t\r\f]*\n|\n[ \t\r\f]*\n", BREAK),
    (rf"\n[ \t\r\f]*((?:{'|'.join(STARTS)})[^a-z])", BREAK + r"\1"),
]


def wrap(ids: list[str]) -> str:
    return "".join(f",{x}," for x in ids)


def _map(forms: dict[str, list[str]]) -> Column:
    return F.create_map(*[F.lit(x) for name, v in forms.items() for form in v for x in (form, name)])


def _identifiers(text: Column) -> Column:
    """The array of known sentences' identifiers of a text, in order."""
    for pattern, instead in STEPS:
        text = F.regexp_replace(text, pattern, re.sub(r"\\(\d)", r"$\1", instead))
    forms = F.transform(F.split(text, BREAK), lambda s: F.trim(F.regexp_replace(ascii_lower(s), "[^a-z0-9]+", " ")))
    name = lambda s: F.regexp_replace(F.regexp_extract(s, UNDER, 1), AFTER, "")
    found = F.transform(forms, lambda s: F.coalesce(F.try_element_at(_map(SENTENCES), s), F.try_element_at(_map(NAMES), name(s))))
    return F.filter(found, lambda x: x.isNotNull())


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_sentences, sentences, licenses, unmatched) for each row; lists are joined by commas."""
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text"))
    cue = F.coalesce(F.col("text"), F.lit("")).rlike(f"(?i){CUES}")
    ids = F.when(cue, _identifiers(F.col("text"))).otherwise(F.array().cast("array<string>"))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(wrap(seq)).alias("seq")) for name, seq in RULES])
    start = F.struct(F.array_join(F.transform("ids", lambda x: F.concat(F.lit(","), x, F.lit(","))), "").alias("left"), F.array().cast("array<string>").alias("found"))
    step = lambda acc, rule: F.struct(
        F.replace(acc["left"], rule["seq"], F.lit(MARK)).alias("left"),
        F.when(F.contains(acc["left"], rule["seq"]), F.concat(acc["found"], F.array(rule["name"]))).otherwise(acc["found"]).alias("found"),
    )
    matched = F.when(F.size("ids") > 0, F.aggregate(rules, start, step)).otherwise(start)
    out = rows.withColumn("ids", ids).withColumn("m", matched)
    left = F.array_join(F.filter(F.split(F.translate("m.left", MARK, ","), ","), lambda x: x != ""), ",")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_sentences"), F.array_join("ids", ",").alias("sentences"), F.array_join(F.array_distinct("m.found"), ",").alias("licenses"), left.alias("unmatched"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licence sentences and licences."""
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    values = lambda of: ", ".join(f"({q(f)}, {q(name)})" for name, v in of.items() for f in v)
    steps = "\n".join(f", r{i + 1} AS (SELECT * REPLACE (replace(lft, {q(wrap(seq))}, {q(MARK)}) AS lft, CASE WHEN contains(lft, {q(wrap(seq))}) AND NOT list_contains(found, {q(name)}) THEN list_append(found, {q(name)}) ELSE found END AS found) FROM r{i})" for i, (name, seq) in enumerate(RULES))
    text = "text"
    for pattern, instead in STEPS:
        text = f"regexp_replace({text}, {q(pattern)}, {q(instead)}, 'g')"
    return f"""
WITH known(form, id) AS (VALUES {values(SENTENCES)}),
names(form, id) AS (VALUES {values(NAMES)}),
d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row FROM documents),
parts AS (SELECT row, string_split({text}, {q(BREAK)}) AS p FROM d WHERE regexp_matches(text, {q(CUES)}, 'i')),
one AS (SELECT row, unnest(p) AS s, generate_subscripts(p, 1) AS i FROM parts),
norm AS (SELECT row, i, trim(regexp_replace(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')) AS s FROM one),
ids AS (SELECT row, i, coalesce(known.id, names.id) AS name FROM norm LEFT JOIN known ON s = known.form
  LEFT JOIN names ON regexp_replace(regexp_extract(s, {q(UNDER)}, 1), {q(AFTER)}, '', 'g') = names.form WHERE coalesce(known.id, names.id) IS NOT NULL),
seq AS (SELECT row, count(*) AS n, string_agg(name, ',' ORDER BY i) AS sentences, string_agg(',' || name || ',', '' ORDER BY i) AS lft FROM ids GROUP BY row),
r0 AS (SELECT row, n, sentences, lft, CAST([] AS VARCHAR[]) AS found FROM seq)
{steps}
SELECT d.doc_id, coalesce(n, 0) AS n_sentences, coalesce(sentences, '') AS sentences, coalesce(array_to_string(found, ','), '') AS licenses,
  coalesce(array_to_string(list_filter(string_split(replace(lft, {q(MARK)}, ','), ','), lambda x: x <> ''), ','), '') AS unmatched
FROM d LEFT JOIN r{len(RULES)} r ON d.row = r.row
"""


SQL = _sql()


def by_hand(text: str | None) -> tuple[list[str], list[str], str]:
    """The same in plain Python, for tests: identifiers, licences, identifiers left over."""
    known = {f: name for name, v in SENTENCES.items() for f in v}
    names = {f: name for name, v in NAMES.items() for f in v}
    text = text or ""
    for pattern, instead in STEPS:
        text = re.sub(pattern, instead, text, flags=re.ASCII)
    lower, ids = str.maketrans(UPPER, UPPER.lower()), []
    for s in text.split(BREAK):
        s = re.sub("[^a-z0-9]+", " ", s.translate(lower)).strip(" ")
        under = re.search(UNDER, s)
        found = known.get(s) or (under and names.get(re.sub(AFTER, "", under[1])))
        ids += [found] * bool(found)
    left, licences = wrap(ids), []
    for name, seq in RULES:
        if wrap(seq) in left:
            licences += [name] * (name not in licences)
            left = left.replace(wrap(seq), MARK)
    return ids, licences, ",".join(x for x in left.replace(MARK, ",").split(",") if x)
