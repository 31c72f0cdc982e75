from __future__ import annotations

import textwrap

import pytest

from ticklake.llm import license_rules as op

SCHEMA = "doc_id long, text string"


def wrapped(names, mark):
    return "\n".join(mark + line for name in names for line in textwrap.wrap(op.SENTENCES[name], 60))


@pytest.mark.parametrize("mark", ["", " * ", "# ", "// "])
@pytest.mark.parametrize("rule", range(len(op.RULES)))
def test_every_rule_is_recognised(rule, mark):
    license_, names = op.RULES[rule]
    text = "Some heading\n" + wrapped(names, mark) + "\n\nint main() {}\n"
    assert op.recognised(text) == [(license_, " > ".join(names), 1, len(names))]


@pytest.mark.parametrize("name", list(op.NAMES))
@pytest.mark.parametrize("lead", ["Licensed under the", "This work is licensed under the", "Released under", "SPDX-License-Identifier:"])
def test_every_name_is_recognised(name, lead):
    assert [found[0] for found in op.recognised(f"Prose before.\n{lead} {name}.\nProse after.")] == [op.NAMES[name]]


def test_order_and_rest():
    text = (
        "Licensed under the MIT License. Other words. Licence terms apply here. "
        "Licensed under the Apache License, Version 2.0.\n" + op.SENTENCES["mit-notice"]
    )
    assert [(f[0], f[2]) for f in op.recognised(text)] == [
        ("MIT", 0),
        ("unknown", 2),
        ("Apache-2.0", 3),
        ("unknown", 4),
    ]


def test_known_sentences_have_an_anchor():
    assert all(op.ANCHOR.search(sentence) for sentence in op.KNOWN)


def test_plain_search_finds_the_same_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {(r.doc_id, r.license) for r in op.licenses(docs).collect()}
    lines = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
    }
    assert found == {(r.doc_id, name) for r in docs.collect() for line, name in lines.items() if line in r.text}


def test_cases(spark):
    rows = [(1, None), (2, ""), (None, "MIT License"), (4, "Released under the MIT License."), (4, "Released under the MIT License.")]
    rows.append((5, "word " * 200_000 + "\n" + "line\n" * 5_000 + "Released under the MIT License."))
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", license string, rule int")
    found = sorted(((r.doc_id, r.license) for r in op.licenses(docs).collect()), key=str)
    assert found == [(4, "MIT"), (4, "MIT"), (5, "MIT"), (None, "unknown")]
    assert op.licenses(docs.limit(0)).collect() == []


def texts(names, **changed):
    return "\n".join(line for name in names for line in textwrap.wrap(changed.get(name.replace("-", "_"), op.SENTENCES[name]), 60))


BSD3 = ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-warranty", "bsd-liability")
HOLDERS = ["Google Inc.", "the University of California, Berkeley", "Foo Bar Ltd. and Baz Corp.", "Jane Q. Public", "<organization>"]


def found(text):
    return [row[0] for row in op.recognised(text)]


@pytest.mark.parametrize("holder", HOLDERS)
def test_any_holder_in_bsd(holder):
    names = op.SENTENCES["bsd-names"].replace("the copyright holder", holder)
    warranty = op.SENTENCES["bsd-warranty"].replace("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", holder.upper().replace(".", ""))
    liability = op.SENTENCES["bsd-liability"].replace("THE COPYRIGHT HOLDER OR CONTRIBUTORS", holder.upper().replace(".", ""))
    text = texts(BSD3, bsd_names=names, bsd_warranty=warranty, bsd_liability=liability)
    assert found("Copyright 2020 " + holder + "\n\n" + text + "\nint x;") == ["BSD-3-Clause"]
    assert found(text.replace("\n", " ")) == ["BSD-3-Clause"]


@pytest.mark.parametrize("holder", ["Jane Doe", "Example Corp"])
def test_any_holder_in_mit_and_isc(holder):
    mit = op.SENTENCES["mit-liability"].replace("THE AUTHORS OR COPYRIGHT HOLDERS", holder.upper())
    assert found(texts(("mit-grant", "mit-notice", "mit-warranty", "mit-liability"), mit_liability=mit)) == ["MIT"]
    warranty = op.SENTENCES["isc-warranty"].replace("THE AUTHOR", holder.upper())
    liability = op.SENTENCES["isc-liability"].replace("THE AUTHOR", holder.upper())
    rule = ("isc-grant", "isc-warranty", "isc-liability")
    assert found(texts(rule, isc_warranty=warranty, isc_liability=liability)) == ["ISC"]


@pytest.mark.parametrize("name", list(op.WORDINGS))
def test_every_wording_is_its_sentence(name):
    for text in op.WORDINGS[name]:
        assert op.KNOWN[op.normalised(text)] == name


def test_no_rule_decides_before_an_unread_sentence():
    two = texts(BSD3[:3])
    assert found(two) == ["BSD-2-Clause"]
    strange = "All advertising needs the written permission of the holder."
    assert found(two + "\n" + strange) == ["unknown", "unknown"]
    assert found(two + "\n\n" + strange) == ["unknown", "unknown"]
    # prose between them: the sentence belongs to something else
    assert found(two + "\n\nSome prose.\n\n" + strange) == ["BSD-2-Clause", "unknown"]
    assert found(texts(BSD3[:3] + BSD3[4:])) == ["BSD-2-Clause"]


@pytest.mark.parametrize(
    ("license_", "kind", "version", "thing"),
    [
        ("LGPL-2.1-or-later", "Lesser ", "2.1", "library"),
        ("LGPL-3.0-or-later", "Lesser ", "3", "library"),
        ("LGPL-2.0-or-later", "Library ", "2", "library"),
        ("AGPL-3.0-or-later", "Affero ", "3", "program"),
        ("GPL-2.0-or-later", "", "2", "software"),
        ("GPL-3.0-or-later", "", "3", "program"),
    ],
)
@pytest.mark.parametrize("mark", ["", " * ", "# "])
@pytest.mark.parametrize("tail", ["url", "write", "joined"])
def test_gnu_notices(license_, kind, version, thing, mark, tail):
    copy = f"You should have received a copy of the GNU {kind}General Public License along with this {thing}"
    end = {
        "url": ".  If not, see <http://www.gnu.org/licenses/>.",
        "write": ". If not, write to the Free Software Foundation, Inc., 59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
        "joined": "; if not, write to the Free Software Foundation, Inc., 675 Mass Ave, Cambridge, MA 02139, USA.",
    }[tail]
    notice = (
        f"This {thing} is free software; you can redistribute it and/or modify it under the terms of the GNU {kind}General "
        f"Public License as published by the Free Software Foundation; either version {version} of the License, or (at your "
        "option) any later version."
    )
    hope = op.SENTENCES["gnu-hope"].replace("program", thing) + f" See the GNU {kind}General Public License for more details."
    lines = [mark + line for part in (notice, hope, copy + end) for line in [*textwrap.wrap(part, 70), ""]]
    assert found("\n".join(lines)) == [license_]


@pytest.mark.parametrize(
    ("text", "meant"),
    [
        ("MIT OR Apache-2.0", "MIT OR Apache-2.0"),
        ("(mit or apache-2.0) and bsd-3-clause", "(MIT OR Apache-2.0) AND BSD-3-Clause"),
        ("GPL-2.0+ WITH Classpath-exception-2.0", "GPL-2.0-or-later WITH Classpath-exception-2.0"),
        ("LGPL-2.1", "LGPL-2.1-only"),
        ("GPL-2.0 WITH Linux-syscall-note */", "GPL-2.0-only WITH Linux-syscall-note"),
        ("LicenseRef-Own OR Zlib", "LicenseRef-Own OR Zlib"),
    ],
)
def test_spdx_expressions(text, meant):
    assert found(f"/* SPDX-License-Identifier: {text}\nint main;") == [meant]


@pytest.mark.parametrize("text", ["", "MIT OR", "OR MIT", "MIT Apache-2.0", "(MIT", "MIT)", "MIT WITH MIT", "() MIT", "MIT, ISC", "Nothing-1.0", "MIT WITH LLVM-exception WITH LLVM-exception"])
def test_no_spdx_expression(text):
    assert op.expression(text) is None


def test_names_joined_in_prose():
    assert found("Licensed under either of Apache License, Version 2.0 or MIT license at your option.") == ["Apache-2.0 OR MIT"]
    assert found("Released under the MIT License and the CC BY 4.0.") == ["MIT AND CC-BY-4.0"]
    assert found("Licensed under the MIT License or something.") == ["unknown"]
