"""Licence scans by canonical digest lookup, with DataFrame functions only.

A text's canonical form: lower case, equivalent spellings made one, lines that begin
with a copyright mark dropped, ASCII punctuation and white space as one space. Whole
texts are joined by the digest of that form to known licence texts (with and without
their titles, and to digests of the long ones); lines are looked
up the same way among known notices. No shuffle: the known texts are a constant of
this module or a table of at most ``MOST_KNOWN`` rows.

Null and empty texts have an empty canonical form, which matches nothing. Repeated
rows are scanned each for itself; an empty table gives no row. Only the id and text
columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import only

MOST_KNOWN = 10_000
#: Equivalent spellings (applied in this order), as in public licence matching guidelines.
SPELLINGS = [
    ("https://", "http://"),
    ("licence", "license"),
    ("organisation", "organization"),
    ("authorisation", "authorization"),
    ("acknowledgement", "acknowledgment"),
    ("favour", "favor"),
    ("non commercial", "noncommercial"),
    ("&", " and "),
    ("‘", "'"),
    ("’", "'"),
    ("“", '"'),
    ("”", '"'),
    ("–", "-"),
    ("—", "-"),
]
#: Known notices, one line each.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("all-rights-reserved", "All rights reserved."),
]
#: Known whole licence texts.
TEXTS = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
]
#: The condition that makes the three-clause form of the two-clause one.
THIRD_CLAUSE = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
TEXTS.append(("BSD-3-Clause", dict(TEXTS)["BSD-2-Clause"].replace("\n\nTHIS SOFTWARE", "\n\n" + THIRD_CLAUSE + "\n\nTHIS SOFTWARE")))
TEXTS.append(("MIT-0", dict(TEXTS)["MIT"].replace(", subject to the following conditions:", ".").replace("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n", "")))
TEXTS += [
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""),
    ("BSL-1.0", """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <http://unlicense.org/>"""),
]
#: Titles under which the texts stand, and what may stand between a copyright line and the text.
TITLES = {"MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"], "ISC": ["ISC License", "The ISC License"], "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"], "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License"], "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License"], "MIT-0": ["MIT No Attribution"], "Zlib": ["zlib License"], "Unlicense": ["The Unlicense"]}
RESERVED = "All rights reserved."
#: Digests of the canonical forms of whole licence texts, as their authors publish them in plain text.
DIGESTS = [
    ("Apache-2.0", "ff7be961361eda3cd2a76927dd0d9482cf45defafde2045befedf77400d98100"),
    ("Artistic-1.0-Perl", "cc2cd6cccfacd5fb622fb0e9b9a373fa9dcb86a8c152213a2b856dfbe24fe304"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "19d29a7c800a0d85704b63b4c09d5cd01dd9a287c61e238f4717d8a9e75d214f"),
    ("GFDL-1.3", "e70f40f3a50995855f972521fe4eaa4af360a4597e5914977b6093cce5243480"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1"),
    ("GPL-3.0", "010ce52b3b970c80b5447205f4afc3b42084811cda2d11b95178b1fd3940764f"),
    ("LGPL-2.0", "9b0b3105b96203f9d9e4b72d4b77951152156c88139302b5aedf6295e3ceaaa3"),
    ("LGPL-2.1", "cb225061bb71741fe8b31a2092e22fe05b1130438158ae5d16c48fd50186e345"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "f77c59051c0127d677dcce7ba0d4733294974749a7b4155250912498d92767d6"),
    ("MPL-2.0", "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9"),
]
_COPYRIGHT = r"(^|\n)[ \t]*(copyright|\(c\)|\x{A9})[^\n]*"
_NOISE = r"[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def canonical_lines(text: Column) -> Column:
    """The canonical form with its line feeds; several may follow each other."""
    out = F.lower(F.coalesce(text, F.lit("")))
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.regexp_replace(F.regexp_replace(out, _COPYRIGHT, "\n"), _NOISE, " ")


def whole(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[\n ]+", " "))


def spelled_out(texts: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Each text by itself, under its titles, after a line that reserves rights, and with both."""
    return [(name, "\n".join([*title, *line, text])) for name, text in texts for title in ([], *[[x] for x in TITLES.get(name, [])]) for line in ([], [RESERVED])]


def known_digests(spark, known: list[tuple[str, str]]) -> DataFrame:
    """(license, digest), one row for each digest: the least name."""
    if len(known) > MOST_KNOWN:
        raise ValueError("too many known texts to broadcast")
    rows = spark.createDataFrame(known, "license string, body string")
    return rows.select("license", F.sha2(whole(canonical_lines(F.col("body"))), 256).alias("digest")).groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, texts: list[tuple[str, str]] = TEXTS, notices: list[tuple[str, str]] = NOTICES, digests: list[tuple[str, str]] = DIGESTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, canonical_sha256, text_license, notices, n_notice_lines) of every whole text.

    text_license: the licence that the entire text is, or null. notices: names of the
    licences that its lines name, in order, with commas between; empty if none.
    """
    spark = docs.sparkSession
    given = spark.createDataFrame(digests, "license string, digest string")
    by_digest = known_digests(spark, spelled_out(texts) + notices).unionByName(given).groupBy("digest").agg(F.min("license").alias("text_license"))
    line_table = {r["digest"]: r["license"] for r in known_digests(spark, notices).collect()}
    lookup = F.create_map(*[F.lit(x) for pair in sorted(line_table.items()) for x in pair]) if line_table else F.lit(None).cast("map<string,string>")
    # A line's digest is taken only where its length is that of a known notice.
    sizes = sorted({r[0] for r in spark.createDataFrame(notices, "license string, body string").select(F.length(whole(canonical_lines(F.col("body"))))).collect()})
    lines = F.transform(F.split("lines", "\n"), lambda x: F.trim(x))
    names = F.filter(F.transform(F.filter(lines, lambda x: F.length(x).isin(sizes)), lambda x: F.element_at(lookup, F.sha2(x, 256))), lambda x: x.isNotNull())
    forms = only(docs, id_col, text_col).select(id_col, canonical_lines(F.col(text_col)).alias("lines"))
    scanned = forms.select(id_col, F.sha2(whole(F.col("lines")), 256).alias("digest"), names.alias("found"))
    return scanned.join(F.broadcast(by_digest), "digest", "left").select(id_col, F.col("digest").alias("canonical_sha256"), "text_license", F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("notices"), F.size("found").cast("long").alias("n_notice_lines"))


def oracle() -> str:
    def form(x: str) -> str:
        out = f"lower(coalesce({x}, ''))"
        for a, b in SPELLINGS:
            q = lambda s: "'" + s.replace("'", "''") + "'"
            out = f"replace({out}, {q(a)}, {q(b)})"
        return f"regexp_replace(regexp_replace({out}, '{_COPYRIGHT}', chr(10), 'g'), '{_NOISE}', ' ', 'g')"

    rows = lambda known: ", ".join("('" + n + "', '" + t.replace("'", "''") + "')" for n, t in known)
    whole_sql = lambda x: f"trim(regexp_replace({x}, '[\\n ]+', ' ', 'g'))"
    return f"""
WITH forms AS (SELECT doc_id, {form("text")} AS lines FROM documents),
known AS (SELECT {whole_sql(form("body"))} AS body, min(license) AS license FROM (VALUES {rows(spelled_out(TEXTS) + NOTICES)}) k(license, body) GROUP BY 1),
digests AS (SELECT digest, min(license) AS license FROM (SELECT sha256(body) AS digest, license FROM known UNION ALL SELECT * FROM (VALUES {", ".join(f"('{d}', '{n}')" for n, d in DIGESTS)}) d(digest, license)) GROUP BY 1),
notices AS (SELECT {whole_sql(form("body"))} AS body, min(license) AS license FROM (VALUES {rows(NOTICES)}) k(license, body) GROUP BY 1),
hits AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(*) AS n FROM (SELECT doc_id, trim(unnest(string_split(lines, chr(10)))) AS l FROM forms) JOIN notices ON l = body GROUP BY doc_id)
SELECT doc_id, digest AS canonical_sha256, license AS text_license, coalesce(notices, '') AS notices, CAST(coalesce(n, 0) AS BIGINT) AS n_notice_lines
FROM (SELECT doc_id, sha256({whole_sql("lines")}) AS digest FROM forms) LEFT JOIN digests USING (digest) LEFT JOIN hits USING (doc_id)"""
