"""Licence scans by canonical digest lookup.

A text is brought to a canonical form (case, punctuation, white space,
copyright lines and equivalent spellings out of the way) and hashed; whole
texts are looked up among the digests of known licence texts by a hash join,
each line in the set of known notices. Only built-in column functions are used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known texts at most; their digests are broadcast.
MAX_KNOWN = 10_000

#: ASCII other than letters, digits and line ends, and the usual non-ASCII marks and spaces.
MARKS_IN_LINE = r"[\x00-\x09\x0b-\x2f\x3a-\x60\x7b-\x7f\x{a0}\x{a9}\x{2010}-\x{201f}]+"
#: What names a right holder's time: a year or a placeholder.
YEAR = r"(?:[0-9]{4}|[<\[{]|yyyy|xxxx)"
#: Notice lines, which are left out of the comparison: copyright with a sign, a year or a placeholder, or a short paragraph of
#: its own. Other lines that begin with the word are of a licence's body, as wrapping has it.
COPYRIGHT_IN_LINE = (
    r"(?dm)^[ \t]*(?:©[^\n]*"
    r"|copyright[ \t]*[:,]?[ \t]*(?:\(c\)|©|&copy;|" + YEAR + r")[^\n]*"
    r"|\(c\)[ \t]*(?:copyright\b|" + YEAR + r")[^\n]*"
    r"|all rights reserved[^\na-z0-9]*$"
    r"|(?<=(?:\A|\n[ \t\r]{0,8}\n)[ \t]{0,8})(?:copyright|\(c\))[ \t][^\n]{0,72}$(?=\n[ \t\r]*(?:\n|\z)|\z))"
)
#: What lies between the words of two lines once marks are spaces.
LINE_ENDS = r" ?\n[ \n]*"
#: The digest of a text without a word: SHA-256 of nothing.
NO_WORDS = hashlib.sha256(b"").hexdigest()
#: Phrases that count as equal to another, as words between single spaces.
EQUIVALENT_PHRASES = (
    (" sub license", " sublicense"),
    (" sub licence", " sublicense"),
    (" non commercial ", " noncommercial "),
    (" per cent ", " percent "),
    (" copyright owner ", " copyright holder "),
    (" whilst ", " while "),
    (" judgement ", " judgment "),
    (" acknowledgement ", " acknowledgment "),
    (" fulfil ", " fulfill "),
    (" wilful ", " willful "),
    (" https ", " http "),
    (" released under ", " licensed under "),
    (" distributed under ", " licensed under "),
)
#: Word endings that count as equal, with the space after the word; letter first, which fails sooner where there is none.
EQUIVALENT_SPELLINGS = (
    (r"c(?<=[a-z]{2}enc)(e|es|ed|ing) ", "s$1 "),
    (r"i(?<=[a-z]{3}i)s(e|es|ed|ing|ation|ations) ", "iz$1 "),
    (r"o(?<=[a-z]{3}o)ur(s|ed|ite|able|) ", "or$1 "),
)
#: Where this isn't found, no phrase is replaced. All phrases begin with a space.
ANY_PHRASE = " (?:" + "|".join(phrase[1:] for phrase, _ in EQUIVALENT_PHRASES) + ")"

#: Texts of public licences, for whole documents.
LICENSE_TEXTS: dict[str, str] = {
    "MIT": """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
""",
    "ISC": """ISC License

Copyright (c) <year> <copyright holders>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.
""",
    "BSD-2-Clause": """BSD 2-Clause License

Copyright (c) <year>, <copyright holders>

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
""",
    "Zlib": """zlib License

(C) <year> <copyright holders>

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution.
""",
    "BSD-3-Clause": """BSD 3-Clause License

Copyright (c) <year>, <copyright holders>

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>
""",
    "0BSD": """BSD Zero Clause License

Copyright (C) <year> <copyright holders>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.
""",
}

#: SHA-256 of the canonical forms of longer public licences, as their publishers' plain text files have them.
LICENSE_DIGESTS: dict[str, str] = {
    "Apache-2.0": "f23f632d75e85b02153b5689b2501dc20f398e8f3280b4394821a8bd7b3f9035",
    "Artistic-1.0-Perl": "ab90bb2ab0a16f6f5c8479843bcd110050fe6a2c8072424cc5fda0b53dc014f2",
    "CC0-1.0": "6a9479bcf17594da510aa411514be2e9b9357447d1f3837cf59bd9a901e7fa18",
    "GFDL-1.2": "adebe6d6edc6a56c4426f97eced14fb50c1c53573246d5b26a73f94c8eeb1e5a",
    "GFDL-1.3": "a12dca205488c939c8ebdbf3e1e02ec6ce29c4a5442e274bfe0cb9a1c4e8972a",
    "GPL-1.0": "4f5afcdc0d25a316d9a012a3753e4db8e0b77356aba4d701d941b89390d30d1a",
    "GPL-2.0": "fb9eba9b575dc38a5ec88649ae9608e98c1548fbeabacfd785c467b67280b251",
    "GPL-3.0": "938edcd3de63edb9cf6fe3e2a92489f9ec0de51e8fb067e66cef583d8d3093b1",
    "LGPL-2.0": "f61865fd17694ddf3c1123c19566ae880b0ef66a1b2248bdbb088a95a67ab8a2",
    "LGPL-2.1": "eee0684ff88b0ef99802902c20fe6c8cffb8370177c4fe99d8a1ed014082b278",
    "LGPL-3.0": "b7fdfbc1886def2a80f6e0ddff33f2cb7335fefdeaa2ed5b161b0c6ae2ce5679",
    "MPL-1.1": "61e5b3cbe2c273f053ba5ff6ff8f3e55696812fc87cf37fd5e4c5d6cf26cd52f",
    "MPL-2.0": "47784d02a08f3ab72d6c2c9f1a74967c2b09aebfa747f453ccfd51a26fd1690c",
}

#: One-line notices that put a document under a licence.
LICENSE_NOTICES: dict[str, tuple[str, ...]] = {
    "MIT": ("Licensed under the MIT License.", "This project is licensed under the MIT License.", "SPDX-License-Identifier: MIT"),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.", 'Licensed under the Apache License, Version 2.0 (the "License");',
        "Licensed under the Apache License 2.0.", "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"),
    "ISC": ("Licensed under the ISC License.", "SPDX-License-Identifier: ISC"),
    "MPL-2.0": ("Licensed under the Mozilla Public License, Version 2.0.", "SPDX-License-Identifier: MPL-2.0"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0"),
    "Unlicense": ("SPDX-License-Identifier: Unlicense",),
    "CC0-1.0": ("SPDX-License-Identifier: CC0-1.0",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"),
}


def word_lines(text: Column) -> Column:
    """The text's lines without notices of copyright, lower-cased, every run of marks in a line a space."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # the same for ASCII, and cheaper
    is_ascii = F.octet_length(text) == F.char_length(text)
    s = F.when(is_ascii, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))
    s = F.regexp_replace(s, COPYRIGHT_IN_LINE, "")
    return F.regexp_replace(s, MARKS_IN_LINE, " ")


def equivalent(words: Column) -> Column:
    """The canonical form of words between single spaces, after the first and last: words that each end in a space."""
    phrases = words
    for phrase, same in EQUIVALENT_PHRASES:
        phrases = F.replace(phrases, F.lit(phrase), F.lit(same))
    s = F.when(words.rlike(ANY_PHRASE), phrases).otherwise(words)
    for pattern, spelling in EQUIVALENT_SPELLINGS:
        s = F.regexp_replace(s, pattern, spelling)
    return F.ltrim(s)


def between_spaces(words: Column) -> Column:
    return F.concat(F.lit(" "), F.trim(words), F.lit(" "))


def digest(words: Column) -> Column:
    """SHA-256 of the canonical form of words :func:`between_spaces`; ``NO_WORDS`` if there is none."""
    return F.sha2(equivalent(words), 256)


def whole_words(lines: Column) -> Column:
    """All words of a text's :func:`word_lines`, between spaces."""
    return between_spaces(F.regexp_replace(lines, LINE_ENDS, " "))


def known_digests(docs: DataFrame, texts: Mapping[str, str], notices: Mapping[str, Sequence[str]], digests: Mapping[str, str]) -> DataFrame:
    rows = [(True, k, v) for k, v in texts.items()] + [(False, k, v) for k, wordings in notices.items() for v in wordings]
    if len(rows) + len(digests) > MAX_KNOWN:
        raise ValueError(f"more than {MAX_KNOWN} known texts")
    known = docs.sparkSession.createDataFrame(rows, "whole boolean, license string, known string")
    known = known.select("whole", "license", digest(whole_words(word_lines(F.col("known")))).alias("known_digest")).filter(F.col("known_digest") != NO_WORDS)
    known = known.union(docs.sparkSession.createDataFrame([(True, k, v) for k, v in digests.items()], known.schema))
    # of texts alike in canonical form, the first name
    return known.groupBy("whole", "known_digest").agg(F.min("license").alias("license"))


def scan_licenses(
    docs: DataFrame,
    texts: Mapping[str, str] = LICENSE_TEXTS,
    notices: Mapping[str, Sequence[str]] = LICENSE_NOTICES,
    digests: Mapping[str, str] = LICENSE_DIGESTS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``text_digest``, ``license_id``, ``notice_ids`` and ``n_notices``, one row per input row.

    ``license_id`` names the known licence whose canonical text equals that of
    the whole document, null if none does; ``notice_ids`` are the distinct
    licences, in order and joined by commas, whose notice equals a line of
    the document, empty if none does, and ``n_notices`` counts such lines.
    ``text_digest`` is that of the whole canonical text. Known are ``texts``,
    the texts with the given canonical ``digests``, and ``notices``, each in
    several wordings; other licences and wordings are not found.

    Null texts and texts without a word have no digest and match nothing. Of
    known texts that agree in canonical form the first name counts. Rows that
    repeat an id are looked up one by one; null ids likewise. Input columns of
    the added names are replaced. Empty input gives an empty result.
    """
    added = ["text_digest", "license_id", "notice_ids", "n_notices"]
    docs = docs.drop(*added)
    known = known_digests(docs, texts, notices, digests)
    whole = F.broadcast(known.filter("whole").select("known_digest", F.col("license").alias("license_id")))
    # at most MAX_KNOWN rows
    names = {r["known_digest"]: r["license"] for r in known.filter("not whole").collect()}
    name_of = F.create_map(*[F.lit(x) for pair in sorted(names.items()) for x in pair])

    rows = docs.select(F.struct("*").alias("row"), word_lines(F.col(text_col)).alias("lines"))
    rows = rows.select("row", whole_words(F.col("lines")).alias("words"), "lines")
    rows = rows.select("row", digest(F.col("words")).alias("form_digest"), _notices(F.col("lines"), sorted(names)).alias("hits"))
    rows = rows.join(whole, F.col("form_digest") == F.col("known_digest"), "left")
    licensed = F.array_sort(F.array_distinct(F.transform("hits", lambda d: name_of[d])))
    return rows.select(
        "row.*",
        F.nullif("form_digest", F.lit(NO_WORDS)).alias("text_digest"),
        "license_id",
        F.coalesce(F.array_join(licensed, ","), F.lit("")).alias("notice_ids"),
        F.coalesce(F.array_size("hits"), F.lit(0)).cast("long").alias("n_notices"),
    )


def _notices(lines: Column, known: Sequence[str]) -> Column:
    """The digests of those lines that are known notices."""
    if not known:
        return F.array().cast("array<string>")
    words = F.transform(F.split(lines, "\n"), between_spaces)
    return F.filter(F.transform(words, digest), lambda d: d.isin(*known))
