"""Licence scans by canonical digests: whole texts and whole lines are normalised and hash-joined to known licences.

DataFrame functions only. The same normal form is written once more as DuckDB SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as the same (applied in this order to lower-case text).
SPELLINGS = (
    ("licence", "license"), ("sub-license", "sublicense"), ("non-commercial", "noncommercial"), ("http://", "https://"),
    ("organisation", "organization"), ("favour", "favor"), ("merchantibility", "merchantability"), ("while ", "whilst "), ("version ", "v"),
)
#: Lines that open like this carry names and years, not terms.
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright|\(c\)|©|all rights reserved)[^\n]*"
NOT_WORD = r"[^\p{L}\p{N}]+"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
# Public licence texts and the usual one-line notices, by identifier.
KNOWN = (
    ("MIT", _MIT), ("MIT", f"MIT License\n{_MIT}"), ("MIT", f"The MIT License (MIT)\n{_MIT}"),
    ("ISC", _ISC), ("ISC", f"ISC License\n{_ISC}"),
    ("BSD-2-Clause", f"{_BSD_2}\n{_BSD_END}"), ("BSD-2-Clause", f"BSD 2-Clause License\n{_BSD_2}\n{_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD_2}\n{_BSD_3}\n{_BSD_END}"), ("BSD-3-Clause", f"BSD 3-Clause License\n{_BSD_2}\n{_BSD_3}\n{_BSD_END}"),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "This project is licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."), ("Apache-2.0", "Licensed under the Apache License 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0", "Licensed under the GNU General Public License, version 3."), ("GPL-3.0", "Released under the GNU General Public License, version 3."), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."), ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."), ("CC0-1.0", "Licensed under CC0 1.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."), ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."), ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
)


# Digests of the normal form of full licence texts, with and without what follows the terms.
DIGESTS = (
    ("Apache-2.0", "75ea8aff520512d1fb5378a602323a8fed58bd7181e7e40a1531e13da4c4ee6d"),
    ("Apache-2.0", "68a53e9e2d1d447f1f4faf747242165bfb194374546e01a6845ad3901c516c21"),
    ("Apache-2.0", "d4be8c31b2d1f7b2f9ed1800c40c0ba1a126fd6c63e8ae1ad2c5603e56e79073"),
    ("Artistic-1.0", "d2d4fc0a4708d351932b90d7fe5010a13b1320be1e034119d07e0245f9c029c7"),
    ("CC0-1.0", "efa01e1f98bc5d90ca373f597e31e8f26b9c2e392a701828ae8cab513d864640"),
    ("GFDL-1.2", "2a61eb8b2c96499f11bcf970b3c56c33e214435e19ff46ce73eedeb97b3c3a84"),
    ("GFDL-1.3", "2f4b9a0754ec8dc3da98f560a73eaa129d7b783cc38c6196d7262815c051ff18"),
    ("GPL-1.0", "d3898f3346d360cd2f8b9debfb24b56ff2edbd352d8be0e73485e4205fca1304"),
    ("GPL-1.0", "1a5f7e87f5bb2ba27190ed3dd8f8a3718f7284f84a6215f0f3ca9e415bb0d2f7"),
    ("GPL-1.0", "2386b21eb79232d8baa87404d128eab400a221acbdefc6c11d9ca4dcb80fbf7c"),
    ("GPL-2.0", "91dcdef628444b564101e8bcab5869eafc235902c0d3aefdd462aba07b776fa2"),
    ("GPL-2.0", "6e302423166642bfebb173ce6bff0145b745c30e3f9be3508bc2dd5548021918"),
    ("GPL-2.0", "8b00c29e937ad7e4baa02885e9503c247aacd94d0b7c6b40e471f9cdb0fe2c18"),
    ("GPL-3.0", "987344417597b417dc5caae0fcdec5deb6fd0cc91b66ac53aa45882e52bfc725"),
    ("GPL-3.0", "0e2f2d4c86c201d99b6e274671f291bf6a71d1b1219c32fa6006c0254fe91a00"),
    ("GPL-3.0", "e13f4b5d12ad076ca8aa9add466c225cb15feb885f5260d5e46c8ac985d8f3b0"),
    ("LGPL-2.0", "66a05dab8339b65fe8cd2c6dd7bafd1a1b2545790e88a4914ab9f503bec69a82"),
    ("LGPL-2.0", "e23bd286b2c390f3e718efc86ed7176a948e3e00e8fc7f3f851625ac7cf1ea64"),
    ("LGPL-2.0", "9a9473586577388f96f023d7764c72ab3487c70415364efcfe0853bbbc63a06e"),
    ("LGPL-2.1", "1e7b43f9ec81ef7e227ab68fe299c415499d644b96d26717500a13175c6839b9"),
    ("LGPL-2.1", "18a45a7fad57dfb8fb52cd4bce391d527e0ace94ba96cdf9d7aa46b03308ea06"),
    ("LGPL-2.1", "fb52e43eebefe8bdf36f8d8c13b69b7ae870b6ec6de047366ca26b39867aa876"),
    ("LGPL-3.0", "5c596d73ce671bf605bbdee26813192c5526af7efd4a060975bec2c6970dcf0f"),
    ("MPL-1.1", "dba8660a00c4b43f720ee45d135abe3997e68e088761ed84f00984e03508dd04"),
    ("MPL-2.0", "02e9a78b0c022a87a400210ba11882edab92be0b82d5b283da9fa7c542dcc6b9"),
)
# Identifiers that SPDX lines name, by identifier without -only and -or-later.
SPDX = (
    "0BSD", "AGPL-3.0", "Apache-2.0", "Artistic-1.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "BSL-1.0", "CC-BY-3.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0",
    "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "GFDL-1.2", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MIT-0",
    "MPL-1.1", "MPL-2.0", "MS-PL", "OFL-1.1", "PostgreSQL", "PSF-2.0", "Unlicense", "WTFPL", "Zlib",
)
SPDX_LINES = tuple((x, f"SPDX-License-Identifier: {x}{end}") for x in SPDX for end in ("", "-only", "-or-later")[: 3 if "GPL" in x or "GFDL" in x else 1])


def normal_form(text: Column) -> Column:
    """Lower case, without copyright lines, one spelling, and single spaces for everything that is no letter or digit."""
    c = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "\n")
    for a, b in SPELLINGS:
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(c, NOT_WORD, " "))


def digest(text: Column) -> Column:
    return F.sha2(normal_form(text), 256)


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """Distinct (digest, license) of known texts, SPDX lines and full texts known by digest; a fixed table."""
    texts = spark.createDataFrame([*known, *SPDX_LINES], "license string, body string").select("license", digest(F.col("body")).alias("digest"))
    return texts.unionAll(spark.createDataFrame(list(DIGESTS), "license string, digest string")).distinct()


def scan(docs: DataFrame, text: str = "text", known=KNOWN) -> DataFrame:
    """doc_id, unit ('text' or 'line'), line (0 for whole texts, else counted from 1), license, digest: one row per unit that
    is a known licence. Null and empty texts have no findings; repeated rows give repeated findings. Lines are looked at if
    they speak of a licence; every text of any length is looked at as a whole; a text that is known under two names gives a row
    for each; rows without id have findings too; further columns are not looked at; an empty table gives an empty result."""
    lines = F.transform(F.split(F.col(text), "\n", -1), lambda x, i: F.struct((i + 1).cast("int").alias("line"), x.alias("body")))
    speaks = F.filter(lines, lambda x: F.lower(x["body"]).contains("licen"))
    whole = F.array(F.struct(F.lit(0).alias("line"), F.col(text).alias("body")))
    named = F.when(F.lower(F.col(text)).contains("licen"), F.concat(whole, speaks)).otherwise(whole)
    units = docs.where(F.col(text).isNotNull()).select("doc_id", F.explode(named).alias("u")).select("doc_id", "u.line", digest(F.col("u.body")).alias("digest"))
    fixed = known_digests(docs.sparkSession, known)
    return units.join(F.broadcast(fixed), "digest").select("doc_id", F.when(F.col("line") == 0, "text").otherwise("line").alias("unit"), "line", "license", "digest")


def _sql_normal(c: str) -> str:
    c = f"regexp_replace(lower({c}), '{COPYRIGHT_LINE}', chr(10), 'g')"
    for a, b in SPELLINGS:
        c = f"replace({c}, '{a}', '{b}')"
    return f"trim(regexp_replace({c}, '{NOT_WORD}', ' ', 'g'))"


def oracle_sql() -> str:
    """DuckDB SQL of scan over documents, with all that known_digests knows."""
    rows = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in (*KNOWN, *SPDX_LINES))
    full = ", ".join(f"('{a}', '{b}')" for a, b in DIGESTS)
    return f"""WITH known AS (SELECT license, sha256({_sql_normal("body")}) AS digest FROM (VALUES {rows}) AS t(license, body) UNION SELECT * FROM (VALUES {full}) AS d(license, digest)),
parts AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS line, unnest(ls) AS body FROM parts),
units AS (SELECT doc_id, 0 AS line, text AS body FROM parts UNION ALL SELECT doc_id, line, body FROM lines WHERE contains(lower(body), 'licen'))
SELECT u.doc_id, CASE WHEN u.line = 0 THEN 'text' ELSE 'line' END AS unit, CAST(u.line AS INTEGER) AS line, k.license, k.digest
FROM (SELECT doc_id, line, sha256({_sql_normal("body")}) AS digest FROM units) u JOIN known k ON u.digest = k.digest"""
