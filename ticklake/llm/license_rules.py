"""Licence recognition by sentences: known sentences have identifiers, licences are rules over them.

A text is split into sentences and each is normalised; a known one is replaced by its identifier.
At each place of the identifier sequence the rules are tried in their order, and the first that
matches takes its sentences. A licence sentence that no rule takes is reported as unknown.

Names of holders, programs and addresses inside a known sentence stand for any other. A rule that
a rule of another licence goes on from does not decide where a licence sentence that nobody knows
follows, since that may be the other licence's. SPDX expressions are one licence each, as written.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ticklake.llm.common import record_batch, sliced, text_of

# Sentences of well-known licences.
SENTENCES = {
    "apache-use": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License."
    ),
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-as-is": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "apache-see": (
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:"
    ),
    "mit-notice": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software."
    ),
    "mit-warranty": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "mit-liability": (
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "bsd-names": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."
    ),
    "bsd-warranty": (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "bsd-liability": (
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS "
        "OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
        "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "isc-warranty": (
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
    ),
    "isc-liability": (
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
        "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
        "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "gpl3-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "gpl2-later": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."
    ),
    "gpl2-only": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License version 2 as published by the Free Software Foundation."
    ),
    "gpl3-only": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License version 3 as published by the Free Software Foundation."
    ),
    "lgpl2-later": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at "
        "your option) any later version."
    ),
    "lgpl21-later": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version."
    ),
    "lgpl3-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."
    ),
    "agpl3-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."
    ),
    "gnu-hope": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "gpl-see": "See the GNU General Public License for more details.",
    "gpl-copy": "You should have received a copy of the GNU General Public License along with this program.",
    "gnu-write": "If not, write to the Free Software Foundation, Inc., 51 Franklin Street, Boston, MA 02110-1301 USA",
    "gnu-url": "If not, see <https://www.gnu.org/licenses/>.",
    "mpl2-terms": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl2-copy": (
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

# Further wordings of the same sentences.
WORDINGS = {
    "bsd-source": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions, and the "
        "following disclaimer.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer in this position and unchanged.",
    ],
    "bsd-binary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. and",
    ],
    "bsd-names": [
        "The name of the author may not be used to endorse or promote products derived from this software without "
        "specific prior written permission.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without prior written permission.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific written permission.",
    ],
    "isc-grant": [
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "gpl2-only": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; version 2 of the License.",
        "This program is free software; you can redistribute it and/or modify it under the terms of version 2 of the "
        "GNU General Public License as published by the Free Software Foundation.",
    ],
    "gpl3-only": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, version 3 of the License.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, version 3.",
    ],
    "gpl-see": [
        "See the GNU Lesser General Public License for more details.",
        "See the GNU Library General Public License for more details.",
        "See the GNU Affero General Public License for more details.",
    ],
    "gpl-copy": [
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "You should have received a copy of the GNU Library General Public License along with this library.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "You should have received a copy of the GNU General Public License along with this program; if not, write to "
        "the Free Software Foundation, Inc., 51 Franklin Street, Boston, MA 02110-1301 USA",
        "You should have received a copy of the GNU Lesser General Public License along with this library; if not, "
        "write to the Free Software Foundation, Inc., 51 Franklin Street, Boston, MA 02110-1301 USA",
        "You should have received a copy of the GNU Library General Public License along with this library; if not, "
        "write to the Free Software Foundation, Inc., 51 Franklin Street, Boston, MA 02110-1301 USA",
        "You should have received a copy of the GNU Affero General Public License along with this program; if not, "
        "write to the Free Software Foundation, Inc., 51 Franklin Street, Boston, MA 02110-1301 USA",
    ],
}

# Names that follow "licensed under", and "SPDX-License-Identifier:".
NAMES = {
    "Apache License, Version 2.0": "Apache-2.0",
    "Apache License 2.0": "Apache-2.0",
    "Apache-2.0": "Apache-2.0",
    "MIT License": "MIT",
    "MIT": "MIT",
    "BSD 2-Clause License": "BSD-2-Clause",
    "BSD-2-Clause": "BSD-2-Clause",
    "BSD 3-Clause License": "BSD-3-Clause",
    "BSD-3-Clause": "BSD-3-Clause",
    "ISC License": "ISC",
    "GNU General Public License, version 2": "GPL-2.0-only",
    "GPL-2.0": "GPL-2.0-only",
    "GPL-2.0-only": "GPL-2.0-only",
    "GPL-2.0-or-later": "GPL-2.0-or-later",
    "GNU General Public License, version 3": "GPL-3.0-only",
    "GPL-3.0": "GPL-3.0-only",
    "GPL-3.0-only": "GPL-3.0-only",
    "GPL-3.0-or-later": "GPL-3.0-or-later",
    "GNU Lesser General Public License, version 2.1": "LGPL-2.1-only",
    "GNU Lesser General Public License, version 3": "LGPL-3.0-only",
    "GNU Affero General Public License, version 3": "AGPL-3.0-only",
    "GNU Lesser General Public License, version 2.1 or later": "LGPL-2.1-or-later",
    "GNU Lesser General Public License, version 3 or later": "LGPL-3.0-or-later",
    "GNU General Public License, version 2 or later": "GPL-2.0-or-later",
    "GNU General Public License, version 3 or later": "GPL-3.0-or-later",
    "GNU Affero General Public License, version 3 or later": "AGPL-3.0-or-later",
    "LGPL-2.1-only": "LGPL-2.1-only",
    "LGPL-2.1-or-later": "LGPL-2.1-or-later",
    "LGPL-3.0-only": "LGPL-3.0-only",
    "LGPL-3.0-or-later": "LGPL-3.0-or-later",
    "AGPL-3.0-only": "AGPL-3.0-only",
    "AGPL-3.0-or-later": "AGPL-3.0-or-later",
    "Mozilla Public License, version 2.0": "MPL-2.0",
    "MPL-2.0": "MPL-2.0",
    "CC0 1.0": "CC0-1.0",
    "CC BY 4.0": "CC-BY-4.0",
    "CC BY-SA 4.0": "CC-BY-SA-4.0",
    "CC BY-ND 4.0": "CC-BY-ND-4.0",
    "CC BY-NC 4.0": "CC-BY-NC-4.0",
    "CC BY-NC-SA 4.0": "CC-BY-NC-SA-4.0",
    "CC BY-NC-ND 4.0": "CC-BY-NC-ND-4.0",
    "Creative Commons Attribution 4.0 International License": "CC-BY-4.0",
    "Creative Commons Attribution-ShareAlike 4.0 International License": "CC-BY-SA-4.0",
    "Creative Commons Attribution-NonCommercial 4.0 International License": "CC-BY-NC-4.0",
}

# Further SPDX identifiers, and exceptions, that expressions may name.
SPDX_IDS = "0BSD BSD-4-Clause BSL-1.0 EPL-2.0 EUPL-1.2 LGPL-2.0-only LGPL-2.0-or-later MIT-0 Unlicense WTFPL Zlib".split()
SPDX_EXCEPTIONS = "Bison-exception-2.2 Classpath-exception-2.0 GCC-exception-3.1 Linux-syscall-note LLVM-exception".split()


def _gnu(license_: str, notice: str) -> list[tuple[str, tuple[str, ...]]]:
    """A GNU notice and what may follow it, the longest first."""
    rest = ("gnu-hope", "gpl-see", "gpl-copy")
    long = [(notice, *rest, "gnu-url"), (notice, *rest, "gnu-write")]
    return [(license_, rule) for rule in [*long, (notice, *rest), (notice, *rest[:2]), (notice, rest[0]), (notice,)]]


# Ordered rules; the first that matches at a place is taken. Rules "licensed under NAME" follow.
RULES = [
    ("Apache-2.0", ("apache-use", "apache-copy", "apache-as-is", "apache-see")),
    ("Apache-2.0", ("apache-use", "apache-copy")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-warranty", "bsd-liability")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-warranty")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty", "bsd-liability")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant", "isc-warranty", "isc-liability")),
    ("ISC", ("isc-grant", "isc-warranty")),
    ("ISC", ("isc-grant",)),
    *_gnu("GPL-3.0-or-later", "gpl3-later"),
    *_gnu("GPL-3.0-only", "gpl3-only"),
    *_gnu("GPL-2.0-or-later", "gpl2-later"),
    *_gnu("GPL-2.0-only", "gpl2-only"),
    *_gnu("LGPL-3.0-or-later", "lgpl3-later"),
    *_gnu("LGPL-2.1-or-later", "lgpl21-later"),
    *_gnu("LGPL-2.0-or-later", "lgpl2-later"),
    *_gnu("AGPL-3.0-or-later", "agpl3-later"),
    ("MPL-2.0", ("mpl2-terms", "mpl2-copy")),
    ("MPL-2.0", ("mpl2-terms",)),
    ("Unlicense", ("unlicense", "mit-warranty", "mit-liability")),
    ("Unlicense", ("unlicense",)),
]

#: What a sentence must contain to be a licence sentence; every known one does.
ANCHOR = re.compile(
    r"licen[cs]e|(?:released|distributed|published|available) under|permission|redistribution|warranty|warranties|liable|mozilla\.org/mpl|distributed with|public domain|free software foundation"
)

#: Sentences end at these marks before white space, but not at the point of "v. 2.0", and at the end of a line that has no more to say.
#: Neither do they end at "Inc." and its like before a small letter or a line's end, nor at the initial of a
#: name. A list of conditions may begin on the same line.
END = re.compile(
    r"(?<!\bv)[.!?](?!(?:(?<=\b[Ii]nc\.)|(?<=\b[Cc]orp\.)|(?<=\b[Ll]td\.)|(?<=\b[Cc]o\.))(?:\s+[a-z]|\s*$)|(?<=\w [A-Z]\.)\s+[A-Z])(?=\s|$)"
    r"|:(?=\s*$)|(?<=\bmet):(?=\s)|(?<=\bconditions):(?=\s)"
)
LEAD = re.compile(
    r"^(?:this (?:work|project|software|program|file|document|text|code|data|package) (?:is|are) )?"
    r"(?:made )?(?:licensed|released|distributed|published|available) under (?:the terms of )?(?:the |an? )?"
)
SPDX = re.compile(r"^spdx license identifier ")
SPDX_LINE = re.compile(r"spdx-licen[cs]e-identifier:\s*(.*)", re.I)
SPDX_TOKEN = re.compile(r"[()]|[\w.+\-]+")
EITHER = re.compile(r"^licensed under (?:either )?(?:of )?(?:the )?(.*?)(?: at your option)?$")
COMMENT = re.compile(r"^[\s>*#/;|\-]+")
NUMBERED = re.compile(r"^\(?[0-9a-z]{1,2}[.)]\s+")
UNREAD = re.compile(r"[^\w.+]+|_|\.(?=\s|$)|(?<=\s)\.")


#: Words without which a normalised sentence has nothing to be replaced.
REPLACED = re.compile(r"https? |names? of |provided (?:by|as)|in no event|free software|distributed in the hope|along with ")

#: What stands in a normalised sentence for any holder, program or address.
PLACEHOLDERS = [
    (re.compile(r"\bhttps? (?=\w)"), ""),
    (
        re.compile(r"^neither the names? of .+? nor the names? of (?:its|his|her|their|any) contributors "),
        "neither the name of holder nor the names of its contributors ",
    ),
    (re.compile(r"^the names? of .+? may not be used to endorse "), "the name of holder may not be used to endorse "),
    (re.compile(r"^this software is provided by .+? as is and any express(?:ed)? "), "this software is provided by holder as is and any express "),
    (re.compile(r"^in no event shall .+? be liable "), "in no event shall holder be liable "),
    (re.compile(r"^the software is provided as is and .+? disclaims? "), "the software is provided as is and holder disclaims "),
    (re.compile(r"^(?:this \w+|(?:gnu )?\S+) is (?=free software you can redistribute |distributed in the hope that )"), "this program is "),
    (re.compile(r" along with [\w.+ ]+?(?= if not |$)"), " along with this program"),
    (re.compile(r"(?<=write to the free software foundation) .*"), ""),
]


def normalised(sentence: str) -> str:
    """Lower case, American spelling, no comment marks, list numbers or punctuation, placeholders for names."""
    text = NUMBERED.sub("", COMMENT.sub("", sentence)).lower().replace("licence", "license")
    text = " ".join(UNREAD.sub(" ", text).split())
    text = LEAD.sub("licensed under ", SPDX.sub("licensed under ", text))
    if REPLACED.search(text):
        for pattern, placeholder in PLACEHOLDERS:
            text = pattern.sub(placeholder, text)
    return text


def _known() -> tuple[dict[str, str], list[tuple[str, tuple[str, ...]]]]:
    known = {normalised(text): name for name, text in SENTENCES.items()}
    known |= {normalised(text): name for name, texts in WORDINGS.items() for text in texts}
    rules = list(RULES)
    for name, license_ in NAMES.items():
        known[normalised(f"Licensed under the {name}.")] = f"under {license_}"
        if (rule := (license_, (f"under {license_}",))) not in rules:
            rules.append(rule)
    return known, rules


KNOWN, ALL_RULES = _known()
LONGEST = max(len(sentence.split()) for sentence in KNOWN)

#: How the first words of a sentence begin that may turn out to be known.
STARTS = re.compile(
    "(?:made|released|distributed|published|available|spdx|"
    + "|".join(sorted({re.escape(sentence.split()[0]) for sentence in KNOWN}))
    + r")\b|(?:gnu )?\S+ is\b"
)

#: Rules that a rule of another licence goes on from.
OPEN_RULES = {
    rule for license_, rule in ALL_RULES for other, longer in ALL_RULES if other != license_ and longer[: len(rule)] == rule
}

#: SPDX identifiers in lower case; old forms, "+" for later versions, mean what SPDX says they do.
IDENTIFIERS = {name.lower(): name for name in [*NAMES.values(), *SPDX_IDS]}
IDENTIFIERS |= {key.removesuffix("-only"): name for key, name in IDENTIFIERS.items() if key.endswith("-only")}
IDENTIFIERS |= {key.removesuffix("-or-later") + "+": name for key, name in IDENTIFIERS.items() if key.endswith("-or-later")}
EXCEPTIONS = {name.lower(): name for name in SPDX_EXCEPTIONS}


def expression(text: str) -> str | None:
    """An SPDX expression with its identifiers as SPDX spells them; None where it is none."""
    text = re.sub(r"\s*(?:\*/|-->|[.;,])\s*$", "", text.strip())
    if SPDX_TOKEN.sub("", text).strip():
        return None
    found: list[str] = []
    depth, before = 0, "AND"  # what came before: an operator, a parenthesis, or an operand
    for token in SPDX_TOKEN.findall(text):
        if token == ")" or token.upper() in ("AND", "OR", "WITH"):
            if before not in ("operand", "exception", ")") or token.upper() == "WITH" and before != "operand":
                return None
            depth -= token == ")"
            before = token.upper()
        elif token == "(":
            if before not in ("AND", "OR", "("):
                return None
            depth += 1
            before = token
        else:
            name = (EXCEPTIONS if before == "WITH" else IDENTIFIERS).get(token.lower())
            name = token if token.startswith("LicenseRef-") and before != "WITH" else name
            if name is None or before not in ("AND", "OR", "WITH", "("):
                return None
            token = name
            before = "exception" if before == "WITH" else "operand"
        if depth < 0:
            return None
        found.append(token.upper() if token.upper() in ("AND", "OR", "WITH") else token)
    if depth or before not in ("operand", "exception", ")"):
        return None
    return " ".join(found).replace("( ", "(").replace(" )", ")")


def named(sentence: str, plain: str) -> str | None:
    """The expression of an SPDX line, or of names joined by "or" or "and" after "licensed under".

    ``plain`` is the normalised sentence.
    """
    if not plain.startswith("licensed under "):
        return None
    if line := SPDX_LINE.search(sentence):
        return expression(line.group(1))
    if names := EITHER.match(plain):
        parts = re.split(r" (or|and) (?:the )?", names.group(1))
        known = [KNOWN.get(f"licensed under {part}") for part in parts[::2]]
        if len(parts) > 1 and all(known):
            parts[::2] = [name.removeprefix("under ") for name in known]
            return " ".join(part.upper() if part in ("or", "and") else part for part in parts)
    return None


def fragments(text: str) -> Iterator[tuple[str, bool]]:
    """(part of a line, whether a sentence ends with it) in order."""
    for line in text.split("\n"):
        at = 0
        for end in END.finditer(line):
            yield line[at : end.end()], True
            at = end.end()
        if line[at:].strip():
            yield line[at:], False
        elif not line.strip():
            yield "", True


def identifiers(text: str) -> list[tuple[int, str | None, int]]:
    """(sentence number, identifier or None, number of the run it is in) of the licence sentences of a text.

    A sentence may run over lines. Of parts without an end, the longest run up to a place that is
    a known sentence is one, so a heading before a licence does not hide it.
    """
    found: list[tuple[int, str | None, int]] = []
    number = run = 0
    open_parts: list[str] = []

    def close() -> None:
        nonlocal number, run
        run += bool(open_parts)
        at = 0
        while at < len(open_parts):
            words, end, best = 0, at, None
            while end < len(open_parts) and words < 4:
                words += len(open_parts[end].split(None, 4))
                end += 1
            lead = " ".join([" ".join(COMMENT.sub("", part).split(None, 8)[:8]) for part in open_parts[at:end]])
            most = LONGEST + 16 if STARTS.match(normalised(lead)) else -1
            words, end = 0, at
            while end < len(open_parts) and words <= most:
                words += len(open_parts[end].split())
                end += 1
                joined = " ".join([COMMENT.sub("", part) for part in open_parts[at:end]])
                plain = normalised(joined)
                if (name := KNOWN.get(plain)) is not None:
                    best = (end, name)
                elif (name := named(joined, plain)) is not None:
                    best = (end, f"names {name}")
            if best is None:
                if ANCHOR.search(open_parts[at].lower().replace("licence", "license")):
                    found.append((number, None, run))
                at += 1
            else:
                found.append((number, best[1], run))
                at = best[0]
            number += 1
        open_parts.clear()

    for part, ends in fragments(text):
        if part:
            open_parts.append(part)
        if ends:
            close()
    close()
    return found


def recognised(text: str) -> list[tuple[str, str, int, int]]:
    """(licence, rule, first sentence, sentences) in the order of the text."""
    if not ANCHOR.search(text.lower()):
        return []
    sentences = identifiers(text)
    names = [name for _, name, _ in sentences]
    found, at = [], 0
    while at < len(names):
        license_, rule = _rule_at(names, at)
        after = at + len(rule)
        if rule in OPEN_RULES and after < len(names) and names[after] is None:
            # the unread sentence next to it may make it another licence
            license_ = "unknown" if sentences[after][2] <= sentences[after - 1][2] + 1 else license_
        found.append((license_, " > ".join(rule), sentences[at][0], len(rule)))
        at = after
    return found


def _rule_at(names: list[str | None], at: int) -> tuple[str, tuple[str, ...]]:
    """The first rule that matches at a place; of a sentence that none takes, itself as unknown."""
    name = names[at]
    if name is None:
        return "unknown", ("",)
    for license_, rule in ALL_RULES:
        if tuple(names[at : at + len(rule)]) == rule:
            return license_, rule
    return (name.removeprefix("names ") if name.startswith("names ") else "unknown"), (name,)


def _license_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("license", pa.string()), ("rule", pa.string())]
        + [("sentence", pa.int64()), ("sentences", pa.int64())]
    )
    for batch in sliced(batches, "text", 1 << 24):
        rows = [
            (doc, *found)
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
            for found in recognised(text)
        ]
        yield record_batch(schema, *([row[i] for row in rows] for i in range(5)))


def licenses(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, license, rule, sentence, sentences): a row per licence found in a row's whole text.

    ``sentence`` counts from 0. Licence sentences that no rule takes give a row "unknown" with
    their identifier, or an empty rule where they have none. Defined cases: a null or empty text has no
    rows; null and repeated ids keep their own rows; other columns of ``docs`` are not looked at. No shuffle.
    """
    rows = docs.select(docs[id].cast("long").alias("doc_id"), text_of(docs, text).alias("text"))
    return rows.mapInArrow(
        _license_batches, "doc_id long, license string, rule string, sentence long, sentences long"
    )
