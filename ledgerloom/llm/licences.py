"""Licence scan by canonical digests, in DataFrame operations only.

A text is brought to a canonical form: ASCII capitals folded, lines with a copyright
notice dropped, everything but letters and digits taken as space, equivalent
spellings replaced by one. Its SHA-256 is joined with the digests of known licence
texts, brought to the same form. Entire texts are compared: the whole document, and
each of its lines as a text of its own, since short notices stand on a line. Known
licences have a fixed number of rows; that is all that is broadcast. They are short
notices and the whole public texts in ``licence_texts``, these in the forms that files
have: with and without title, closing instructions and "All rights reserved".

Null and empty texts, and texts without letters or digits, have no digest and match
nothing. Identical rows (id and text) are reported once; rows with equal ids and
different texts are told apart by ``text_sha256``.
"""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that mean the same in licence texts, by the SPDX matching guidelines.
EQUIVALENT = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("centre", "center"), ("copyright holder", "copyright owner"), ("emphasised", "emphasized"),
    ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"),
    ("licence", "license"), ("maximise", "maximize"), ("modelled", "modeled"), ("modelling", "modeling"),
    ("noncommercial", "non commercial"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"),
    ("organise", "organize"), ("per cent", "percent"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("sub license", "sublicense"),
    ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "wilfull"),
)

#: Notices and short licence texts with their SPDX identifiers.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    # a line of the usual header notice
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    # a line of the notice as it is wrapped in the licence
    ("MPL-2.0", "License, v. 2.0. If a copy of the MPL was not distributed with this"),
    ("Zlib", "SPDX-License-Identifier: Zlib"),
)

#: Titles that stand above the whole texts, in one or more lines.
TITLES = {
    "Apache-2.0": ("Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License"),
    "CC-BY-SA-4.0": ("Attribution-ShareAlike 4.0 International", "Creative Commons Attribution-ShareAlike 4.0 International"),
    "CC0-1.0": ("Creative Commons Legal Code CC0 1.0 Universal", "CC0 1.0 Universal"),
    "GPL-2.0-only": ("GNU GENERAL PUBLIC LICENSE Version 2, June 1991",),
    "GPL-3.0-only": ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "MPL-2.0": ("Mozilla Public License Version 2.0", "Mozilla Public License, version 2.0"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License"),
}
#: Whole texts whose first lines may be followed by "All rights reserved."
RESERVED = ("BSD-2-Clause", "BSD-3-Clause", "ISC", "MIT", "Zlib")
#: After this line come instructions that many files leave out.
END = "END OF TERMS AND CONDITIONS"
#: The line that a project fills in (as a copyright notice it is then dropped).
BLANK_NOTICE = "Copyright [yyyy] [name of copyright owner]"


def _untitled(name: str, text: str) -> str:
    """``text`` without its title, which may go over several lines."""
    lines = text.split("\n")
    for n in range(1, len(lines)):
        if " ".join(" ".join(lines[:n]).split()) in TITLES[name]:
            rest = lines[n:]
            while rest and not rest[0].strip("= "):
                rest = rest[1:]
            if " ".join(" ".join([*lines[:n], rest[0]]).split()) not in TITLES[name]:
                return "\n".join(rest)
    return text


def _forms(name: str, text: str) -> list[str]:
    """The forms in which a whole text is known."""
    bodies = [_untitled(name, text)]
    if BLANK_NOTICE in text:
        bodies.append(bodies[0].replace(BLANK_NOTICE, ""))
    if END in text:
        cut = bodies[0][: bodies[0].index(END)]
        bodies += [cut, cut + END]
    if name in RESERVED and "\n1. " in text:
        bodies += [b.replace("\n1. ", "\n* ").replace("\n2. ", "\n* ").replace("\n3. ", "\n* ") for b in bodies]
    if name in RESERVED:
        bodies += ["All rights reserved.\n\n" + b for b in bodies]
    return [x for b in bodies for x in (b, *(f"{t}\n\n{b}" for t in TITLES[name]))]


def _whole_texts() -> list[tuple[str, str]]:
    found = [(f.name, f.read_text("utf-8")) for f in files(__package__).joinpath("licence_texts").iterdir() if f.name.endswith(".txt")]
    # 'GPL-2.0-only.spdx.txt': another wording of that licence
    named = [(n.removesuffix(".txt").removesuffix(".spdx").removesuffix(".header"), n, t) for n, t in sorted(found)]
    long = [(n, t) for n, t in NOTICES if n in ("ISC", "MIT") and "\n" in t]
    whole = [(n, t) for n, f, t in named if not f.endswith(".header.txt")] + long
    headers = [(n, t) for n, f, t in named if f.endswith(".header.txt")]
    return headers + [(n, x) for n, t in whole for x in _forms(n, t)]


#: Notices and whole texts.
KNOWN = tuple(dict.fromkeys((*NOTICES, *_whole_texts())))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A line that begins with a copyright notice, after comment signs, in folded text.
NOTICE = r"(^|\n)[^a-z0-9\n]*(copyright[^a-z0-9\n]*(\(c\)|©|[0-9])|\(c\)[^a-z0-9\n]*[0-9]|©)[^\n]*"
#: What a line with such a notice has, in any case.
HINT = r"(?i)copyright|\(c\)"
#: What is no letter, digit or line end.
OTHER = r"[^\p{L}\p{N}\n]+"


def _plain(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``text`` in small letters, without notices, other signs as spaces, line by line."""
    folded = F.translate(text, UPPER, LOWER)
    noticed = F.contains(F.col(text), F.lit("©")) | F.regexp_like(text, F.lit(HINT))
    rows = rows.withColumn(out, F.when(noticed, F.regexp_replace(folded, NOTICE, "$1")).otherwise(folded))
    return rows.withColumn(out, F.regexp_replace(out, OTHER, " "))


def _spelled(rows: DataFrame, form: str) -> DataFrame:
    """``form`` with one spelling of each; the replacements run only where one occurs."""
    single = [x + s for x, _ in EQUIVALENT if " " not in x for s in ("", "s")]
    some = F.arrays_overlap(F.split(form, " "), F.array(*map(F.lit, single)))
    for x, _ in EQUIVALENT:
        if " " in x:
            some = some | F.contains(F.col(form), F.lit(x))
    spelled = F.col(form)
    for x, y in EQUIVALENT:
        spelled = F.regexp_replace(spelled, rf"\b{x}(s?)\b", f"{y}$1")
    return rows.withColumn(form, F.when(some, spelled).otherwise(F.col(form)))


def _digest(rows: DataFrame, form: str) -> DataFrame:
    rows = _spelled(rows, form)
    return rows.withColumn("digest", F.when(F.col(form) != "", F.sha2(form, 256))).drop(form)


def _whole(plain: Column) -> Column:
    return F.trim(F.regexp_replace(plain, "[ \n]+", " "))


def known_licences(spark: SparkSession, known: tuple = KNOWN) -> DataFrame:
    """(licence, digest) of the known texts; equal digests count once, for the smallest name."""
    rows = F.array(*(F.struct(F.lit(n).alias("licence"), F.lit(t).alias("text")) for n, t in known))
    texts = spark.range(1).select(F.explode(rows).alias("k")).select("k.licence", "k.text")
    forms = _plain(texts, "text", "plain").select("licence", _whole(F.col("plain")).alias("form"))
    return _digest(forms, "form").groupBy("digest").agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``docs(doc_id, text)``, ``known(licence, digest)`` -> doc_id, text_sha256, digest (of the
    canonical whole text), licence (of the whole text), n_lines (matching ones), line_licences
    (distinct, by name, comma-joined)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    # in steps, so that no step's expression is copied into the next and evaluated again
    plain = _plain(rows, "text", "plain").select("doc_id", F.sha2("text", 256).alias("text_sha256"), "plain")
    whole = F.struct(F.lit(True).alias("whole"), _whole(F.col("plain")).alias("form"))
    lines = F.transform(F.split("plain", "\n"), lambda x: F.struct(F.lit(False).alias("whole"), F.trim(x).alias("form")))
    parts = plain.select("doc_id", "text_sha256", F.explode(F.concat(F.array(whole), lines)).alias("p"))
    hashed = _digest(parts.select("doc_id", "text_sha256", "p.whole", "p.form"), "form")
    met = hashed.join(F.broadcast(known), "digest", "left")  # a fixed number of licences
    at_line = ~F.col("whole") & F.col("licence").isNotNull()
    return met.groupBy("doc_id", "text_sha256").agg(
        F.max(F.when(F.col("whole"), F.col("digest"))).alias("digest"),
        F.max(F.when(F.col("whole"), F.col("licence"))).alias("licence"),
        F.sum(at_line.cast("long")).alias("n_lines"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(at_line, F.col("licence"))))).alias("line_licences"),
    )
