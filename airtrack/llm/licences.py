"""Licence texts by the digest of their canonical form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Licence texts and notices, copyright lines left out; the digest is taken of their canonical form.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES '
    "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
    "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
    "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_AUTHOR = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_CONTRIBUTORS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT '
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
    "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_REDISTRIBUTION = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution. "
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software. "
) + _AS_IS
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You '
    "may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
    'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
    "either express or implied. See the License for the specific language governing permissions and limitations under the License."
)
LICENCES = (
    ("MIT", _MIT),
    ("MIT", "MIT License " + _MIT),
    ("MIT", "The MIT License (MIT) " + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC + ", provided that the above copyright notice and this permission notice appear in all copies. " + _AUTHOR),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("0BSD", _ISC + ". " + _AUTHOR),
    ("BSD-2-Clause", _REDISTRIBUTION + _CONTRIBUTORS),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    (
        "BSD-3-Clause",
        _REDISTRIBUTION + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. " + _CONTRIBUTORS,
    ),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)

# Spellings that count as equal, after lower-casing; whole words.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("sub license", "sublicense"), ("non infringement", "noninfringement"), ("non commercial", "noncommercial"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("organisation", "organization"),
    ("acknowledgement", "acknowledgment"), ("favour", "favor"), ("whilst", "while"), ("judgement", "judgment"),
    ("copyright owner", "copyright holder"), ("share alike", "sharealike"), ("https", "http"),
)
#: Every known text holds one of these; texts that do not hold one cannot be known.
HINT = r"(?i)licen[cs]e|permission|redistribution"

_COPYRIGHT_LINE = r"(?im)^[^\p{L}\p{N}\n]*(?:copyright(?!\s+(?:holder|notice))|\(c\)|©|all rights reserved)[^\n]*$"


def canonical(text: Column) -> Column:
    """Copyright lines dropped, lower case, anything but letters and digits one space, one spelling."""
    plain = F.regexp_replace(text, _COPYRIGHT_LINE, "")
    plain = F.trim(F.regexp_replace(F.lower(plain), r"[^\p{L}\p{N}]+", " "))
    for other, usual in SPELLINGS:
        plain = F.regexp_replace(plain, rf"\b{other}\b", usual)
    return plain


def known(spark: SparkSession, texts: tuple[tuple[str, str], ...] = LICENCES) -> DataFrame:
    """``digest, licence`` of the known texts; as many rows as the tuple has."""
    rows = spark.createDataFrame(list(texts), "licence string, text string")
    return rows.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "licence").distinct()


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: tuple[tuple[str, str], ...] = LICENCES
) -> DataFrame:
    """``id, licence, unit, n``: which known texts the rows hold, and how often.

    A unit is the ``text`` as a whole, a ``paragraph`` (between empty lines) or a ``line``; the digest of its canonical form must
    equal that of a known text.  A unit of several kinds counts as the largest.  Known texts are a short fixed list, which is
    all that is broadcast; documents are not shuffled, only hits are counted.  A null or empty text has no hits; repeated rows
    count together; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).filter(F.col("text").rlike(HINT))
    units = F.concat(
        F.array(F.struct(F.lit("text").alias("unit"), F.col("text").alias("part"))),
        *(
            F.transform(F.filter(F.split("text", cut), lambda p: p.rlike(HINT)), lambda p: F.struct(F.lit(unit).alias("unit"), p.alias("part")))
            for unit, cut in (("paragraph", r"\n[ \t]*\n\s*"), ("line", r"\n"))
        ),
    )
    parts = rows.select("id", F.explode(units).alias("u")).select("id", "u.unit", F.sha2(canonical(F.col("u.part")), 256).alias("digest"))
    order = F.when(F.col("unit") == "text", 0).when(F.col("unit") == "paragraph", 1).otherwise(2)
    hits = parts.join(F.broadcast(known(spark, texts)), "digest")
    per_part = hits.groupBy("id", "licence", "digest").agg(
        F.min(F.struct(order, "unit")).getField("unit").alias("unit"), F.sum((F.col("unit") == "line").cast("long")).alias("lines"),
    )
    n = F.when(F.col("unit") == "line", F.col("lines")).otherwise(F.greatest("lines", F.lit(1)))
    return per_part.groupBy("id", "licence", "unit").agg(F.sum(n).cast("long").alias("n"))

