"""License scan by canonical digests.

A text is brought into a canonical form (case, copyright lines, equivalent spellings, punctuation)
and its SHA-256 digest is joined with the digests of known license texts.  The entire text of a
document is looked up, and every line of it as a text of its own, which finds license notices.
The list of licenses is a table; Spark broadcasts its digests only where it has measured them to
be small.  The built-in list holds the notices below and the full texts in ``license_texts``.

Defined results: NULL, empty and punctuation-only texts and lines match nothing; of licenses with
equal canonical texts the first name counts; repeated rows get equal results, also for a NULL id;
an empty list or table is allowed.  Only the id and the text are read.
"""

from __future__ import annotations

import re
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.text import ascii_lower, whole
from tidemark.session import materialize

# Spellings that license matching treats as equal.
SPELLINGS = [
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("copyright holder", "copyright owner"),
    ("organisation", "organization"),
    ("authorisation", "authorization"),
    ("https://", "http://"),
    ("(c)", "©"),
]
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright|©)[^\n]*$"
SIGNS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Notices and short licenses, by SPDX name.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This project is licensed under the Apache License 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO "
        "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR "
        "BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING "
        "FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
]


# Titles that full texts are given with or without.
TITLES = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "The BSD 3-Clause License", "BSD License", 'BSD 3-Clause "New" or "Revised" License',
    ],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "Zlib": ["zlib License", "The zlib License", "zlib License (Zlib)"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}
APPENDIX = "APPENDIX: How to apply the Apache License to your work."
_NOTICE = re.compile(r"\s*(copyright|©)\s*(\(c\)|©|\[|<|\d|$)", re.IGNORECASE)


def _unwrapped(text: str) -> str:
    """A text with one line per paragraph; copyright notices stay lines of their own."""
    out, joins = [], False
    for line in text.split("\n"):
        notice = _NOTICE.match(line) is not None
        if joins and line.strip() and not notice:
            out[-1] += " " + line.strip()
        else:
            out.append(line.strip())
        joins = bool(line.strip()) and not notice
    return "\n".join(out)


def license_texts() -> list[tuple[str, str]]:
    """Full texts by SPDX name, as they are usually given: with and without a title, list numbers
    or an appendix, and with lines as in the original or one line per paragraph."""
    bodies = {f.name[: -len(".txt")]: f.read_text("utf-8") for f in (files(__package__) / "license_texts").iterdir()}
    out = []
    for name, body in sorted([*bodies.items(), ("0BSD", KNOWN[-1][1])]):
        forms = [body]
        if name.startswith("BSD"):
            forms.append(re.sub(r"(?m)^\d\. ", "* ", body))
        if APPENDIX in body:
            forms.append(body[: body.index(APPENDIX)])
        forms += [_unwrapped(f) for f in forms]
        heads = ["", *[t + "\n\n" for t in TITLES.get(name, [])]]
        if name in TITLES:
            heads += [h + "All rights reserved.\n\n" for h in heads]
        out += [(name, head + form) for head in heads for form in forms]
    return out


def known_licenses(spark: SparkSession) -> DataFrame:
    """The built-in list, notices and full texts: license, text."""
    return spark.createDataFrame(KNOWN + license_texts(), "license string, text string")


def canonical(text: Column) -> Column:
    """Canonical form of a text; empty where nothing but signs is left."""
    out = ascii_lower(whole(text))
    for given, used in SPELLINGS:
        out = F.replace(out, F.lit(given), F.lit(used))
    out = F.regexp_replace(out, COPYRIGHT_LINE, "")
    return F.trim(F.regexp_replace(out, SIGNS, " "))


def license_digests(licenses: DataFrame) -> DataFrame:
    """One row per distinct canonical text: digest, license."""
    forms = licenses.select("license", canonical(F.col("text")).alias("form")).where("form != ''")
    return forms.groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("license").alias("license"))


def license_scan(docs: DataFrame, licenses: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, license (of the entire text), line_licenses (distinct, in
    order), license_lines (number of lines that are a license text), digest (of the canonical text)."""
    # Stored, so that its size is that of the digests, not of the texts.
    known = materialize(license_digests(licenses))
    texts = docs.select(F.col(id).alias("id"), whole(F.col(text)).alias("text"))
    named = known.select(F.col("digest").alias("line_digest"), F.col("license").alias("line_license"))
    lines = (
        texts.select("id", F.xxhash64("text").alias("hash"), F.posexplode(F.split("text", "\n")).alias("at", "line"))
        .select("id", "hash", "at", F.sha2(canonical(F.col("line")), 256).alias("line_digest"))
        .join(named, "line_digest")
        .groupBy("id", "hash")
        .agg(F.collect_set(F.struct("at", "line_license")).alias("found"))
        .select(F.col("id").alias("_id"), F.col("hash").alias("_hash"), "found")
    )
    whole_texts = texts.select(
        "id", F.xxhash64("text").alias("hash"), F.sha2(canonical(F.col("text")), 256).alias("digest")
    ).join(known, "digest", "left")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    none = F.array().cast("array<string>")
    return whole_texts.join(lines, same, "left").select(
        F.col("id").alias(id),
        "license",
        F.coalesce(F.array_sort(F.array_distinct("found.line_license")), none).alias("line_licenses"),
        F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("license_lines"),
        "digest",
    )
