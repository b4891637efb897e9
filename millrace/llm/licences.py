"""Licence scan by canonical digests, in DataFrame functions only.

A text is brought into canonical form: lines that are a copyright mark are dropped (not sentences wrapped before "copyright notice" and the like), letters lower-cased, everything but letters and
digits is taken out (so line breaks and blanks don't count), and equivalent spellings are made one. The SHA-256 of the whole canonical text is joined to the digests of
known licence texts. Single lines are held against one-line notices in the same way (their copyright marks stay); lines too long to
shrink to the longest notice are skipped, which loses none: spelling takes away less than `1 - SHRINK` of a line.

Null texts and texts that are empty in canonical form have a null digest and match nothing. If known texts share a canonical form, the
name that sorts first stands for it. Rows that share an id are one document as far as notices go; each keeps its own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shared import written

#: Spellings that count as the same, without blanks. Applied in this order.
SPELLINGS = (
    ("licence", "license"), ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("behaviour", "behavior"), ("cancelled", "canceled"), ("centre", "center"), ("colour", "color"),
    ("favour", "favor"), ("fulfilment", "fulfillment"), ("honour", "honor"), ("organisation", "organization"), ("programme", "program"), ("recognised", "recognized"), ("whilst", "while"),
    ("copyrightholders", "copyrightholder"), ("copyrightowners", "copyrightholder"), ("copyrightowner", "copyrightholder"), ("authorsor", "authoror"),
)
SHRINK = 0.7

#: Known licence texts, as published by their authors, without their copyright lines.
TEXTS = {
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-1-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDERS AND CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "FSFAP": """Copying and distribution of this file, with or without modification, are permitted in any medium without royalty provided the copyright notice and this notice are preserved. This file is offered as-is, without any warranty.""",
    "Fair": """Usage of the works is permitted provided that this instrument is retained with the works, so that any entity that uses the works is notified of this instrument.
DISCLAIMER: THE WORKS ARE WITHOUT WARRANTY.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MIT-0": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>""",
    "WTFPL": """DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION
0. You just DO WHAT THE FUCK YOU WANT TO.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
}

#: Titles that files with these texts begin with; a text is known with and without each of them.
TITLES = {
    "0BSD": ("Zero-Clause BSD", "BSD Zero Clause License"),
    "BSD-1-Clause": ("BSD 1-Clause License",),
    "BSD-2-Clause": ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "The BSD 2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "The BSD 3-Clause License"),
    "BSL-1.0": ("Boost Software License - Version 1.0 - August 17th, 2003",),
    "Fair": ("Fair License",),
    "FSFAP": ("FSF All Permissive License",),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "MIT-0": ("MIT No Attribution", "MIT No Attribution License"),
    "Unlicense": ("The Unlicense",),
    "WTFPL": ("DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\nVersion 2, December 2004\nEveryone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",),
    "Zlib": ("zlib License", "The zlib/libpng License"),
}


def whole_texts() -> list[tuple[str, str]]:
    """(name, text) of every known whole text, with and without its titles."""
    return [(name, f"{title}\n{text}") for name, text in TEXTS.items() for title in ("", *TITLES.get(name, ()))]


#: Notices of one line.
NOTICES = {
    "all-rights-reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "This work is dedicated to the public domain.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Licensed under the MIT License.",
}

#: What follows "copyright" where a sentence of a licence was wrapped before it, and no holder.
NO_HOLDER = (
    "notice", "holder", "owner", "license", "licence", "law ", "law,", "law.", "laws ", "laws,", "laws.", "statement", "interest", "protection", "permission", "disclaimer", "claim", "act ", "infring",
    "treaties", "registration", "and ", "and/", "or ", "in ", "on ", "to ", "is ", "as ", "for ", "of ", "under ", "line ", "text ", "file ", "right ", "rights ", "work ", "year ", "date ", "message ", "header ",
)


def _not_begun_by(words: tuple[str, ...]) -> str:
    """Pattern of the beginnings of what begins with none of the words; without lookahead, which not every SQL has."""
    firsts = sorted({w[0] for w in words})
    others = "[^" + "".join(firsts) + r" \t:,\n]"
    return f"({others}|" + "|".join(c.replace(".", "[.]") + _inside(tuple(w[1:] for w in words if w[0] == c)) for c in firsts if all(w[1:] for w in words if w[0] == c)) + ")"


def _inside(words: tuple[str, ...]) -> str:
    firsts = sorted({w[0] for w in words})
    deeper = [c.replace(".", "[.]") + _inside(tuple(w[1:] for w in words if w[0] == c)) for c in firsts if all(w[1:] for w in words if w[0] == c)]
    return "(" + "|".join(["[^" + "".join(firsts) + r"\n]", *deeper]) + ")"


#: A line that is a copyright mark, maybe in a comment: "copyright" and a sign, a year or a holder; or a sign first. "(c)" alone is also a number of a list, so it takes a year.
COPYRIGHT_LINE = r"(^|\n)[ \t]*[*#;%!/<>|-]*[ \t]*(copyright[ \t:,]*(\(c\)|©|[0-9])|copyright[ \t:,]+" + _not_begun_by(NO_HOLDER) + r"|\(c\)[ \t,]*(copyright|©|[0-9])|©)[^\n]*"
NOT_WORD = r"[^\p{L}\p{N}]+"
NOT_WORD_OR_BREAK = r"[^\p{L}\p{N}\n]+"


def spelt(text: Column) -> Column:
    for one, other in SPELLINGS:
        text = F.replace(text, F.lit(one), F.lit(other))
    return text


def canonical(text: Column) -> Column:
    """Canonical form of a whole text."""
    return spelt(F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "\n"), NOT_WORD, ""))


def known(spark: SparkSession, texts: dict[str, str] | list[tuple[str, str]], whole: bool) -> DataFrame:
    """(known, size, name): digest of each known text, its length and its name."""
    df = spark.createDataFrame(sorted(texts.items() if isinstance(texts, dict) else texts), "name string, text string")
    df = df.select("name", (canonical(F.col("text")) if whole else spelt(F.regexp_replace(F.lower("text"), NOT_WORD, ""))).alias("c"))
    return df.where("c <> ''").groupBy(F.sha2("c", 256).alias("known")).agg(F.max(F.length("c")).alias("size"), F.min("name").alias("name"))


def scan(docs: DataFrame, texts: dict[str, str] | None = None, notices: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: id, canonical_sha256, license (null: none), notices (names, sorted, comma-joined), n_notice_lines."""
    spark = docs.sparkSession
    licences = known(spark, whole_texts() if texts is None else texts, True)
    lines = known(spark, NOTICES if notices is None else notices, False)
    longest = lines.agg(F.max("size")).first()[0] or 0
    low = docs.select(F.col(id_col).alias("_id"), F.lower(text_col).alias("low"))
    parts = low.select("_id", canonical(F.col("low")).alias("c"), F.split(F.regexp_replace("low", NOT_WORD_OR_BREAK, ""), "\n").alias("lines"))
    short = F.filter("lines", lambda x: (x != "") & (F.length(x) * SHRINK <= longest))
    rows = written(parts.select("_id", F.when(F.col("c") != "", F.sha2("c", 256)).alias("canonical_sha256"), short.alias("lines")))
    marked = (
        rows.select("_id", F.explode("lines").alias("line"))
        .select("_id", F.sha2(spelt(F.col("line")), 256).alias("known"))
        .join(lines, "known")
        .groupBy("_id")
        .agg(F.array_join(F.array_sort(F.collect_set("name")), ",").alias("notices"), F.count("*").alias("n_notice_lines"))
        .withColumnRenamed("_id", "_of")
    )
    whole = rows.join(licences.select(F.col("known").alias("canonical_sha256"), F.col("name").alias("license")), "canonical_sha256", "left")
    return whole.join(marked, F.col("_id").eqNullSafe(F.col("_of")), "left").select(
        F.col("_id").alias(id_col), "canonical_sha256", "license", F.coalesce("notices", F.lit("")).alias("notices"), F.coalesce("n_notice_lines", F.lit(0)).cast("bigint").alias("n_notice_lines")
    )
