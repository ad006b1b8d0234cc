import duckdb
import pytest
from helpers import docs

from pyspark.sql import functions as F

from rollkeeper.llm.licences import MORE_RULES, MORE_SENTENCES, RULES, SENTENCES, SQL, TEXT_RULES, op3_licences, scan

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions
of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""
CASES = [
    (None, ""),
    ("", ""),
    ("no licence here. none", ""),
    ("text with no end\nLicensed under the Apache License, Version 2.0.\nmore", "Apache-2.0"),
    ("All rights reserved. Released under the MIT License.", "MIT,Proprietary"),
    (MIT, "MIT"),
    (MIT.replace("The above", "Some other sentence; the above"), "MIT"),
    ("SPDX-License-Identifier: GPL-3.0-only\n" * 3, "GPL-3.0"),
    ("// SPDX-License-Identifier: MIT\nint main() {}", "MIT"),
    ("# SPDX-License-Identifier: Apache-2.0\r\nimport os", "Apache-2.0"),
    ("/* SPDX-License-Identifier: BSD-3-Clause */ int x;\n/* SPDX-License-Identifier: ISC */\nint y;", "ISC"),
    ("SPDX-License-Identifier:MIT", "MIT"),
    ("x SPDX-License-Identifier: MIT", ""),
    ("x | y ~ z. Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("This work is licensed under the GNU General Public License, version 3.\r\nx", "GPL-3.0"),
    ("a. " * 50_000 + "Licensed under CC BY 4.0", "CC-BY-4.0"),
    ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", ""),
]


def test_cases_and_sql(spark, tmp_path):
    path = docs(tmp_path, [t for t, _ in CASES])
    out = op3_licences(spark, path)
    got = {r.doc_id: tuple(r) for r in out.collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    assert {r[0]: r for r in con.execute(SQL["op3_licences"]).fetchall()} == got
    assert [got[i][3] for i in range(len(CASES))] == [x for _, x in CASES]


ALL_RULES = [*TEXT_RULES, *RULES, *MORE_RULES]


def wording(sequence):
    """A text with the known sentences of a rule; those of which some identifier has several, by the first."""
    first = {}
    for sentence, identifier in (SENTENCES | MORE_SENTENCES).items():
        first.setdefault(identifier, sentence)
    return ". ".join(first[i] for i in sequence.split()) + "."


def test_every_rule_can_match(spark, tmp_path):
    """Each rule is reached from the wording of its sentences, here and in the SQL."""
    path = docs(tmp_path, [wording(s) for _, s in ALL_RULES])
    got = {r.doc_id: tuple(r) for r in op3_licences(spark, path).collect()}
    for k, (licence, sequence) in enumerate(ALL_RULES):
        assert (got[k][1], got[k][3]) == (sequence, licence)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    assert {r[0]: r for r in con.execute(SQL["op3_licences"]).fetchall()} == got


def test_every_sentence_is_known(spark, tmp_path):
    """Each known sentence, tags included, gives its identifier."""
    known = list((SENTENCES | MORE_SENTENCES).items())
    texts = [s.replace("spdx license identifier ", "SPDX-License-Identifier: ") for s, _ in known]
    got = sorted(tuple(r) for r in op3_licences(spark, docs(tmp_path, texts)).collect())
    assert [r[1] for r in got] == [i for _, i in known]


def test_sql_on_notices(spark, tmp_path):
    texts = [text for text, *_ in [*WRAPPED, *ORIGINAL]]
    texts += ["\r\n".join(" * " + line for line in text.split("\n")) for text in texts]
    path = docs(tmp_path, texts)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    assert sorted(con.execute(SQL["op3_licences"]).fetchall()) == sorted(tuple(r) for r in op3_licences(spark, path).collect())


def test_clashing_columns(spark, tmp_path):
    df = spark.read.parquet(docs(tmp_path, ["Released under the MIT License."]) + "/documents.parquet")
    for name in ("_marked", "_running", "_lines", "licences", "running_ids"):
        df = df.withColumn(name, F.lit("x"))
    assert [r.licences for r in scan(df).collect()] == ["MIT"]


def test_empty(spark, tmp_path):
    assert op3_licences(spark, docs(tmp_path, [])).collect() == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_sql_on_the_test_tables(spark, folder):
    import os

    if not os.path.exists(folder):
        pytest.skip("test tables are not here")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    theirs = sorted(con.execute(SQL["op3_licences"]).fetchall())
    assert sorted(tuple(r) for r in op3_licences(spark, folder).collect()) == theirs
    assert any(r[3] for r in theirs)


ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
FULL_MIT = """MIT License

Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
WRAPPED = [
    (FULL_MIT, "mitGrant mitNotice mitAsIs mitLiable", "MIT"),
    ("ISC License\n\nCopyright (c) 2020, Jane Doe\n\n" + ISC, "iscGrant", "ISC"),
    ("Copyright (c) 2020, Jane Doe\n\n" + BSD, "bsdHead bsdSource bsdBinary bsdNames", "BSD-3-Clause"),
    (APACHE, "apacheHead apacheUse apacheCopy apacheAsIs apacheSee", "Apache-2.0"),
]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_wrapped_notices(spark, tmp_path, mark, end):
    texts = [end.join(mark + line for line in text.split("\n")) for text, _, _ in WRAPPED]
    got = sorted(tuple(r) for r in op3_licences(spark, docs(tmp_path, texts)).collect())
    assert [(r[1], r[3]) for r in got] == [(ids, licence) for _, ids, licence in WRAPPED]


FREE = """This {0} is free software{1} you can redistribute it and/or modify
it under the terms of the GNU {2} as published by
the Free Software Foundation{3} either version {4} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {2} for more details.

You should have received a copy of the GNU {2}
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
GPL, LESSER, AFFERO = (f"{x}General Public License" for x in ("", "Lesser ", "Affero "))
ORIGINAL = [
    (FREE.format("program", ":", GPL, ",", 3), "gplOr3 gplHope gplSee gplCopy", "GPL-3.0-or-later"),
    (FREE.format("program", ";", GPL, ";", 2), "gplOr2 gplHope gplSee gplCopy", "GPL-2.0-or-later"),
    (FREE.format("library", ";", LESSER, ";", "2.1"), "lgplOr21 gplHope", "LGPL-2.1-or-later"),
    (FREE.format("library", ":", LESSER, ",", 3), "lgplOr3 gplHope", "LGPL-3.0-or-later"),
    (FREE.format("program", ":", AFFERO, ",", 3), "agplOr3 gplHope", "AGPL-3.0-or-later"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not", "mplRef", "MPL-2.0"),
    ("To the extent possible under law, the author(s) have dedicated all\ncopyright and related and neighboring rights to this software to the\npublic domain worldwide.", "cc0Grant", "CC0-1.0"),
    ("This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy", "unlicenseGrant", "Unlicense"),
    ("This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/", "eplRef", "EPL-2.0"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007", "gpl3Text", "GPL-3.0"),
    ("GNU LESSER GENERAL PUBLIC LICENSE\n  Version 2.1, February 1999\n\n Copyright", "lgpl21Text", "LGPL-2.1"),
    ("Apache License\n  Version 2.0, January 2004\n  http://www.apache.org/licenses/\n\n  TERMS", "apacheText", "Apache-2.0"),
    ("Mozilla Public License Version 2.0\n==================================\n\n1. Definitions", "mplText", "MPL-2.0"),
    ("SPDX-License-Identifier: MIT\n\nint x;", "mitRef", "MIT"),
    ("Copyright 2020 Jane Doe\n\nSPDX-License-Identifier: LGPL-3.0-or-later", "lgplOr3", "LGPL-3.0-or-later"),
]


@pytest.mark.parametrize("mark", ["", " * "])
def test_original_wording(spark, tmp_path, mark):
    texts = ["\n".join(mark + line for line in text.split("\n")) for text, _, _ in ORIGINAL]
    got = sorted(tuple(r) for r in op3_licences(spark, docs(tmp_path, texts)).collect())
    assert [(r[1], r[3]) for r in got] == [(ids, licence) for _, ids, licence in ORIGINAL]
