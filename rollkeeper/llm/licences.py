"""Licence recognition by sentences: known sentences become identifiers, ordered rules read their sequence.

A text is cut into sentences twice over: with line breaks as blanks (running text) and
at line breaks too (notices on a line of their own). A sentence is normalised (A-Z to
small letters, everything but a-z and 0-9 to single blanks) and looked up among the
known sentences; others are left out. In running text a line without letters and digits
ends a sentence. Signs that stand inside a known sentence end none, nor does the colon of an
SPDX tag, which is thus found on a line of its own, whatever follows. The sequence of identifiers of either reading is
matched against the rules in their order; a rule takes the identifiers it has matched
away from later rules. The result does not depend on other documents.

Null or empty text: no sentence, no licence. Repeated rows each get their own result, and a
very long text is one row like any other. An empty table gives an empty result. Other columns
are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeeper.llm.common import documents

#: Normalised sentence -> identifier. Public licence wording.
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mitGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mitNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mitAsIs",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mitLiable",
    "released under the mit license": "mitRef",
    "licensed under the mit license": "mitRef",
    "this project is licensed under the mit license": "mitRef",
    "spdx license identifier mit": "mitRef",
    "licensed under the apache license version 2 0 the license": "apacheHead",
    "you may not use this file except in compliance with the license": "apacheUse",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apacheCopy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apacheAsIs",
    "see the license for the specific language governing permissions and limitations under the license": "apacheSee",
    "licensed under the apache license version 2 0": "apacheRef",
    "spdx license identifier apache 2 0": "apacheRef",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gplOr3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gplOr2",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gplHope",
    "see the gnu general public license for more details": "gplSee",
    "you should have received a copy of the gnu general public license along with this program": "gplCopy",
    "this work is licensed under the gnu general public license version 3": "gpl3Ref",
    "licensed under the gnu general public license version 3": "gpl3Ref",
    "spdx license identifier gpl 3 0 only": "gpl3Ref",
    "licensed under the gnu general public license version 2": "gpl2Ref",
    "spdx license identifier gpl 2 0 only": "gpl2Ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsdHead",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsdNames",
    "spdx license identifier bsd 3 clause": "bsd3Ref",
    "spdx license identifier bsd 2 clause": "bsd2Ref",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "iscGrant",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mplRef",
    "licensed under cc by nc 4 0": "ccByNc4",
    "licensed under cc by sa 4 0": "ccBySa4",
    "licensed under cc by 4 0": "ccBy4",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccBy4",
    "all rights reserved": "reserved",
}

#: Licence and its sequence of identifiers; earlier rules go first.
RULES = [
    ("MIT", "mitGrant mitNotice mitAsIs mitLiable"),
    ("MIT", "mitGrant mitNotice mitAsIs"),
    ("Apache-2.0", "apacheHead apacheUse apacheCopy apacheAsIs apacheSee"),
    ("Apache-2.0", "apacheHead apacheUse"),
    ("GPL-3.0-or-later", "gplOr3 gplHope gplSee gplCopy"),
    ("GPL-3.0-or-later", "gplOr3"),
    ("GPL-2.0-or-later", "gplOr2 gplHope gplSee gplCopy"),
    ("GPL-2.0-or-later", "gplOr2"),
    ("BSD-3-Clause", "bsdHead bsdSource bsdBinary bsdNames"),
    ("BSD-2-Clause", "bsdHead bsdSource bsdBinary"),
    ("ISC", "iscGrant"),
    ("MIT", "mitRef"),
    ("Apache-2.0", "apacheRef"),
    ("GPL-3.0", "gpl3Ref"),
    ("GPL-2.0", "gpl2Ref"),
    ("BSD-3-Clause", "bsd3Ref"),
    ("BSD-2-Clause", "bsd2Ref"),
    ("MPL-2.0", "mplRef"),
    ("CC-BY-NC-4.0", "ccByNc4"),
    ("CC-BY-SA-4.0", "ccBySa4"),
    ("CC-BY-4.0", "ccBy4"),
    ("Proprietary", "reserved"),
]

#: Full texts, and licences of the same families.
MORE_SENTENCES = {
    "gnu general public license version 3 29 june 2007": "gpl3Text",
    "gnu general public license version 2 june 1991": "gpl2Text",
    "gnu lesser general public license version 3 29 june 2007": "lgpl3Text",
    "gnu lesser general public license version 2 1 february 1999": "lgpl21Text",
    "gnu affero general public license version 3 19 november 2007": "agpl3Text",
    "apache license version 2 0 january 2004 http www apache org licenses": "apacheText",
    "mozilla public license version 2 0": "mplText",
    "eclipse public license v 2 0": "eplText",
    "cc0 1 0 universal": "cc0Text",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "lgplOr21",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgplOr3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgplOr3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agplOr3",
    "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide": "cc0Grant",
    "this is free and unencumbered software released into the public domain": "unlicenseGrant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "eplRef",
    "spdx license identifier gpl 3 0 or later": "gplOr3",
    "spdx license identifier gpl 2 0 or later": "gplOr2",
    "spdx license identifier lgpl 3 0 or later": "lgplOr3",
    "spdx license identifier lgpl 2 1 or later": "lgplOr21",
    "spdx license identifier lgpl 3 0 only": "lgpl3Text",
    "spdx license identifier lgpl 2 1 only": "lgpl21Text",
    "spdx license identifier agpl 3 0 or later": "agplOr3",
    "spdx license identifier agpl 3 0 only": "agpl3Text",
    "spdx license identifier mpl 2 0": "mplRef",
    "spdx license identifier isc": "iscGrant",
    "spdx license identifier epl 2 0": "eplRef",
    "spdx license identifier cc0 1 0": "cc0Grant",
    "spdx license identifier unlicense": "unlicenseGrant",
}

#: A licence's full text holds a sample notice, so these go before ``RULES``.
TEXT_RULES = [
    ("GPL-3.0", "gpl3Text gplOr3 gplHope gplSee gplCopy"),
    ("GPL-2.0", "gpl2Text gplOr2 gplHope gplSee gplCopy"),
    ("AGPL-3.0", "agpl3Text agplOr3 gplHope"),
    ("LGPL-2.1", "lgpl21Text lgplOr21"),
]
MORE_RULES = [
    ("GPL-3.0", "gpl3Text"),
    ("GPL-2.0", "gpl2Text"),
    ("LGPL-3.0-or-later", "lgplOr3"),
    ("LGPL-2.1-or-later", "lgplOr21"),
    ("AGPL-3.0-or-later", "agplOr3"),
    ("LGPL-3.0", "lgpl3Text"),
    ("LGPL-2.1", "lgpl21Text"),
    ("AGPL-3.0", "agpl3Text"),
    ("Apache-2.0", "apacheText"),
    ("MPL-2.0", "mplText"),
    ("EPL-2.0", "eplText"),
    ("EPL-2.0", "eplRef"),
    ("CC0-1.0", "cc0Text"),
    ("CC0-1.0", "cc0Grant"),
    ("Unlicense", "unlicenseGrant"),
]

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# After the first step `|` ends a sentence and `~` a line; neither is left from the text.
ENDS = "[.!?;:]+(?:[ \\t\\r\\n]+|$)"
REST = "[^a-z0-9|~]+"
EMPTY_LINES = " ?~ ?(?:~ ?)+"
#: Signs inside known sentences, which end none ("free software; you can", "v. 2.0").
INSIDE = (
    "((?:software|foundation|warranty|license[ ~]{1,9}v) ?)[|][ ~]*"
    "(you[ ~]+can[ ~]+redistribute|either[ ~]+version|without[ ~]+even[ ~]+the[ ~]+implied|2 0)"
)
TAG = "spdx license identifier"
#: The same in running text, where an empty line stands between.
APART, TOGETHER = "a copy of the license at|http", "a copy of the license at http"


def _ids(sentences: Column) -> Column:
    """`` id id `` of the known sentences in order, each between single blanks."""
    known = F.create_map(*[F.lit(x) for pair in (SENTENCES | MORE_SENTENCES).items() for x in pair])
    found = F.filter(F.transform(sentences, lambda s: known[F.trim(s)]), lambda i: i.isNotNull())
    return F.concat(F.lit(" "), F.concat_ws("  ", found), F.lit(" "))


def _matched(ids: Column) -> list[Column]:
    """For each rule its licence or null; a rule's identifiers are taken out of what later rules see."""
    out = []
    for licence, sequence in [*TEXT_RULES, *RULES, *MORE_RULES]:
        mark = " " + sequence.replace(" ", "  ") + " "
        out.append(F.when(ids.contains(mark), F.lit(licence)))
        ids = F.replace(ids, F.lit(mark), F.lit(" - "))
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: the id, the identifiers of both readings, and the licences (sorted, comma-joined)."""
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER + "|~", SMALL + "  ")
    text = F.regexp_replace(F.regexp_replace(text, ENDS, "|\n"), "\n", "~")
    text = F.regexp_replace(F.regexp_replace(text, REST, " "), INSIDE, "$1 $2")
    marked = docs.select(F.col(id_col), F.replace(text, F.lit(f"{TAG}|~"), F.lit(f"{TAG} ")).alias("_marked"))
    running = F.regexp_replace(F.regexp_replace("_marked", EMPTY_LINES, "|"), "[ ~]+", " ")
    running = F.replace(running, F.lit(APART), F.lit(TOGETHER))
    ids = marked.select(
        id_col,
        _ids(F.split(running, "[|]")).alias("_running"),
        _ids(F.split("_marked", "[|~]")).alias("_lines"),
    )
    found = F.array_compact(F.array(*_matched(F.col("_running")), *_matched(F.col("_lines"))))
    return ids.select(
        id_col,
        F.regexp_replace(F.trim("_running"), " +", " ").alias("running_ids"),
        F.regexp_replace(F.trim("_lines"), " +", " ").alias("line_ids"),
        F.array_join(F.array_sort(F.array_distinct(found)), ",").alias("licences"),
    )


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def _sql() -> str:
    known = ", ".join(f"'{s}': '{i}'" for s, i in (SENTENCES | MORE_SENTENCES).items())
    pick = "' ' || array_to_string(list_filter(list_transform({}, lambda s: k[trim(s)]), lambda i: i IS NOT NULL), '  ') || ' '"

    def reading(name: str) -> tuple[str, list[str]]:
        steps, hits = name, []
        for licence, sequence in [*TEXT_RULES, *RULES, *MORE_RULES]:
            mark = " " + sequence.replace(" ", "  ") + " "
            hits.append(f"CASE WHEN contains({steps}, '{mark}') THEN '{licence}' END")
            steps = f"replace({steps}, '{mark}', ' - ')"
        return steps, hits

    hits = [*reading("running")[1], *reading("lines")[1]]
    return f"""
WITH known AS (SELECT MAP {{{known}}} AS k),
marked AS (
  SELECT doc_id, replace(regexp_replace(regexp_replace(replace(regexp_replace(
    translate(coalesce(text, ''), '{UPPER}|~', '{SMALL}  '), '{ENDS}', '|' || chr(10), 'g'),
    chr(10), '~'), '{REST}', ' ', 'g'), '{INSIDE}', '\\1 \\2', 'g'), '{TAG}|~', '{TAG} ') AS m FROM documents),
running AS (
  SELECT *, replace(regexp_replace(regexp_replace(m, '{EMPTY_LINES}', '|', 'g'), '[ ~]+', ' ', 'g'), '{APART}', '{TOGETHER}') AS r FROM marked),
ids AS (
  SELECT doc_id, {pick.format("string_split(r, '|')")} AS running,
    {pick.format("string_split(replace(m, '~', '|'), '|')")} AS lines
  FROM running, known)
SELECT doc_id, regexp_replace(trim(running), ' +', ' ', 'g') AS running_ids,
  regexp_replace(trim(lines), ' +', ' ', 'g') AS line_ids,
  array_to_string(list_sort(list_distinct(list_filter([{', '.join(hits)}], lambda x: x IS NOT NULL))), ',') AS licences
FROM ids"""


SQL = {"op3_licences": _sql()}
