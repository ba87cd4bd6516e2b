"""Licence scan by canonical digests: normalised units of text are hash-joined to known licence texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that count as equal, British or split form first.
SPELLINGS = [("licences", "licenses"), ("licence", "license"), ("licenced", "licensed"), ("licencing", "licensing"), ("licencee", "licensee"),
             ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"),
             ("per cent", "percent"), ("acknowledgement", "acknowledgment"), ("organisation", "organization"), ("favour", "favor"),
             ("whilst", "while"), ("wilful", "willful"), ("v 2 0", "version 2 0"), ("v2 0", "version 2 0"),
             ("v 3", "version 3"), ("v3", "version 3"), ("https", "http")]

# What the two BSD licences share.
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. ")
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
    "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

#: Notices and short licence texts by SPDX identifier. Copyright lines do not count.
KNOWN = [
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
     "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
     'in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either '
     "express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
     "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial "
     'portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
     "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
     "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
     "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-2-Clause", _BSD_START + _BSD_END),
    ("BSD-3-Clause", _BSD_START + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
     "products derived from this software without specific prior written permission. " + _BSD_END),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms are permitted under the BSD-3-Clause license."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
     "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
     "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be "
     "misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
     "product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
     "misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
     "this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
     "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
     "FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public "
     "License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
     'the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
     "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
     "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
     "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
     "SOFTWARE."),
]

#: Lines that name a holder or claim rights; they differ between copies of one licence.
COPYRIGHT_LINE = r"(?imd)^[ \t]*(?:copyright\b|\(c\)|©|all rights reserved)[^\n]*$"


#: Known digests that are broadcast at most, some 100 bytes each.
BROADCAST_DIGESTS = 100_000


def _like_spelling(text: Column) -> Column:
    for old, new in SPELLINGS:
        text = F.replace(text, F.lit(f" {old} "), F.lit(f" {new} "))
    return text


def _words(text: Column) -> Column:
    """Lower-case words between single spaces, without copyright lines and punctuation."""
    return F.trim(F.lower(F.regexp_replace(F.regexp_replace(text, COPYRIGHT_LINE, " "), r"[^\p{L}\p{N}]+", " ")))


def _spelled(words: Column) -> Column:
    return F.trim(_like_spelling(F.concat(F.lit(" "), words, F.lit(" "))))


def canonical(text: Column) -> Column:
    """Lower-case words between single spaces, without copyright lines, punctuation and differences of spelling.

    A text without words is empty; null stays null.
    """
    return _spelled(_words(text))


def digest_table(texts: DataFrame, id_col: str = "license_id", text_col: str = "body") -> DataFrame:
    """(digest, license_id) of a table of licence texts, to be kept and passed to :func:`scan`: one row per canonical text.

    Any collection will do, one row per notice or whole text, such as an export of a licence list. Of texts that are equal
    in their canonical form the first id by name counts; null texts, and those without words, are left out.
    """
    rows = texts.select(F.col(id_col).alias("license_id"), canonical(F.col(text_col)).alias("words")).where("words <> ''")
    return rows.groupBy(F.sha2("words", 256).alias("digest")).agg(F.min("license_id").alias("license_id"))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """The digest table of the notices and licences listed here."""
    return digest_table(spark.createDataFrame(known, "license_id string, body string"))


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, unit, line, license_id, digest): whole texts and single lines that are a known licence.

    ``unit`` is ``text`` (line 0) or ``line`` (numbered from 1). Each unit's canonical form is compared as a whole, by
    its SHA-256. A text of one line that is a licence gives both rows. ``known`` is a table of :func:`digest_table`; up to
    ``BROADCAST_DIGESTS`` rows are broadcast, and then nothing is shuffled; a larger table is joined by shuffle, for which
    only digests move.

    Null and empty texts, and units without words, match nothing. Repeated rows give repeated results, an empty table
    gives an empty one; other columns are ignored.
    """
    lines = F.transform(F.split(text_col, "\n"), _words)  # words end at line ends, so the text's are its lines'
    rows = docs.select(F.col(id_col).alias("doc_id"), lines.alias("lines"))
    whole = F.struct(F.lit("text").alias("unit"), F.lit(0).alias("line"), F.array_join(F.filter("lines", lambda w: w != ""), " ").alias("words"))
    each = F.transform("lines", lambda w, i: F.struct(F.lit("line").alias("unit"), (i + 1).alias("line"), w.alias("words")))
    units = rows.select("doc_id", F.inline(F.concat(F.array(whole), each))).where("words <> ''")
    digests = units.select("doc_id", "unit", "line", _spelled(F.col("words")).alias("words"))
    # never null, so that the join needs no second evaluation to filter nulls out
    digests = digests.select("doc_id", "unit", "line", F.coalesce(F.sha2("words", 256), F.lit("")).alias("digest"))
    small = known.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS
    return digests.join(F.broadcast(known) if small else known, "digest").select("doc_id", "unit", "line", "license_id", "digest")
