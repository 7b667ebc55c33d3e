"""Licence scan by canonical digest lookup.

A text is brought to a canonical form (lower case, equivalent spellings,
copyright lines out, punctuation and spacing as single spaces), and the
SHA-256 of the whole form is hash-joined to the digests of known licences,
canonicalised in the same way. Two texts that differ only in what the form
drops have one digest; any other difference gives another.

Defined cases: null and empty texts, and texts of nothing but copyright lines,
have the empty canonical form, which matches no licence. Repeated rows each
get a row. A licence listed twice under different names matches once, by its
smallest name. Extra columns pass through; names the operator adds replace
equal ones.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh

# FIXED VALUES: spellings that licence matching guidelines treat as equal
EQUIVALENT = [
    ("acknowledgment", "acknowledgement"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("labour", "labor"), ("licence", "license"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("modelling", "modeling"), ("noncommercial", "non commercial"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("sub license", "sublicense"),
    ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
]

# FIXED VALUES: whole texts of short public licences and notices (names are SPDX identifiers or plain descriptions)
WARRANTY_MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
WARRANTY_ISC = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
    "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
WARRANTY_BSD = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
    "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.\n"
)
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
KNOWN = [
    ("MIT", f"{MIT_GRANT}, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n{WARRANTY_MIT}"),
    ("MIT (with title)", f"MIT License\n{MIT_GRANT}, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n{WARRANTY_MIT}"),
    ("MIT-0", f"{MIT_GRANT}.\n{WARRANTY_MIT}"),
    ("ISC", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n{WARRANTY_ISC}"),
    ("0BSD", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n{WARRANTY_ISC}"),
    ("BSD-2-Clause", f"{BSD_HEAD}{WARRANTY_BSD}"),
    ("BSD-3-Clause", f"{BSD_HEAD}3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n{WARRANTY_BSD}"),
    ("Apache-2.0 notice", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("Apache-2.0 line", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0 line", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0 line", "Licensed under CC BY-NC 4.0."),
    ("MIT line", "Released under the MIT License."),
]

MAX_LENGTHS = 10_000  # distinct canonical lengths of the known licences
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"


def line_forms(text: Column) -> Column:
    """The text with every line in canonical form but for the number of spaces:
    case, copyright lines, punctuation and spellings are done, line breaks stay."""
    t = F.lower(F.coalesce(text, F.lit("")))
    t = F.regexp_replace(t, COPYRIGHT_LINE, "")
    # every word stands between two spaces of its own, so neighbours can both be replaced
    t = F.regexp_replace(t, r"[^\p{L}\p{N}\n]+", "  ")
    t = F.concat(F.lit("  "), F.replace(t, F.lit("\n"), F.lit("  \n  ")), F.lit("  "))
    for a, b in EQUIVALENT:
        t = F.replace(t, F.lit(f" {_spaced(a)} "), F.lit(f" {_spaced(b)} "))
    return t


def _spaced(words: str) -> str:
    return words.replace(" ", "  ")


def _single(t: Column) -> Column:
    return F.trim(F.regexp_replace(t, " +", " "))


def whole_form(lines: Column) -> Column:
    """Canonical form of a whole text from its line forms: line breaks are
    spaces, also inside the spellings of two words."""
    t = F.regexp_replace(lines, r"[ \n]+", "  ")
    for a, b in EQUIVALENT:
        if " " in a:
            t = F.replace(t, F.lit(f" {_spaced(a)} "), F.lit(f" {_spaced(b)} "))
    return _single(t)


def canonical(text: Column) -> Column:
    """Canonical form of a whole text."""
    return whole_form(line_forms(text))


def shipped_digests() -> list[tuple[str, str, int]]:
    """(license, digest, length) of whole licences whose texts are not kept here:
    canonicalised once, by this module's form."""
    rows = resources.files(__package__).joinpath("license_digests.tsv").read_text("utf-8").splitlines()
    return [(name, digest, int(length)) for name, digest, length in (r.split("\t") for r in rows)]


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(digest, license, length): one row per digest of a known text, and of the
    shipped digests."""
    df = spark.createDataFrame(known, "license string, body string").select("license", canonical(F.col("body")).alias("form"))
    df = df.select("license", F.sha2("form", 256).alias("digest"), F.length("form").alias("length"))
    df = df.unionByName(spark.createDataFrame(shipped_digests(), "license string, digest string, length int"))
    return df.groupBy("digest").agg(F.min("license").alias("license"), F.first("length").alias("length"))


def digests(df: DataFrame, licenses: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, canonical_sha256, canonical_length, lines) of every row, in one pass:
    the digest of the whole text, and the digests of those lines whose canonical
    length some known licence has (others cannot match)."""
    lengths = [r[0] for r in licenses.select("length").distinct().limit(MAX_LENGTHS + 1).collect()]
    if len(lengths) > MAX_LENGTHS:
        raise ValueError(f"known licences of more than {MAX_LENGTHS} lengths")
    known = F.array(*[F.lit(int(x)) for x in lengths]).cast("array<int>")
    t = df.select(F.col(key), line_forms(F.col(text)).alias("_forms"))
    t = t.select(key, whole_form(F.col("_forms")).alias("_whole"), F.transform(F.split("_forms", "\n", -1), _single).alias("_lines"))
    lines = F.transform(F.filter("_lines", lambda x: F.array_contains(known, F.length(x))), lambda x: F.sha2(x, 256))
    return t.select(key, F.sha2("_whole", 256).alias("canonical_sha256"), F.length("_whole").cast("long").alias("canonical_length"), lines.alias("lines"))


def known_licenses(table: DataFrame, licenses: DataFrame) -> DataFrame:
    """``table`` (see ``digests``) with the ``license`` of the whole text, null if
    it is none. A plain equi-join on digests: the planner broadcasts the licences
    while they are small."""
    (digest,) = fresh(table, "_digest")
    known = licenses.select(F.col("digest").alias(digest), "license")
    return table.join(known, (F.col("canonical_sha256") == F.col(digest)) & (F.col("canonical_length") > 0), "left").drop(digest)


def license_lines(table: DataFrame, licenses: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per (document, licence) for lines that, as whole texts of their
    own, are a known licence or notice: (key, license, n_lines)."""
    rows = table.select(key, F.explode("lines").alias("digest"))
    return rows.join(licenses, "digest").groupBy(key, "license").agg(F.count(F.lit(1)).alias("n_lines"))


def scan(df: DataFrame, licenses: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``canonical_sha256``, ``canonical_length`` and ``license`` (null:
    no known licence) of every row's whole text."""
    out = df.select(*[c for c in df.columns if c not in ("canonical_sha256", "canonical_length", "license")])
    (form,) = fresh(out, "_form")
    out = out.withColumn(form, canonical(F.col(text)))
    out = out.withColumns({"canonical_sha256": F.sha2(form, 256), "canonical_length": F.length(form).cast("long")}).drop(form)
    return known_licenses(out, licenses)
