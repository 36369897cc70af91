import textwrap

import pytest

from cityloom.llm.licenses import TEMPLATES, Scanner


@pytest.fixture(scope="module")
def scanner():
    return Scanner(TEMPLATES)


def found(scanner, text):
    return [(f.license, f.status, f.differences) for _, _, f in scanner.scan(text)]


def commented(text, mark):
    return "\n".join(mark + line for line in textwrap.wrap(text, 70, break_on_hyphens=False))


GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
    "version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public "
    "License along with this program. If not, see <https://www.gnu.org/licenses/>."
)


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_gnu_notices(scanner, mark):
    assert found(scanner, commented(GPL, mark)) == [("GPL-3.0-or-later-notice", "exact", "")]
    for word, name in (("GNU Lesser General", "LGPL-3.0"), ("GNU Affero General", "AGPL-3.0")):
        assert found(scanner, commented(GPL.replace("GNU General", word), mark)) == [(f"{name}-or-later-notice", "exact", "")]
    assert found(scanner, commented(GPL.replace("version 3", "version 2").replace("software:", "software;"), mark)) == [("GPL-2.0-or-later-notice", "exact", "")]


def test_numbered_text(scanner):
    text = "Copyright (c) 2001, The Owner\nAll rights reserved.\n\n" + TEMPLATES["BSD-3-Clause-full"].replace("are met: ", "are met:\n\n1. ")
    text = text.replace(" Redistributions in binary", "\n\n2. Redistributions in binary").replace(" Neither the name", "\n\n3. Neither the name").replace(" THIS SOFTWARE", "\n\nTHIS SOFTWARE")
    assert found(scanner, text) == [("all-rights-reserved", "exact", ""), ("BSD-3-Clause-full", "exact", "")]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("This file is licensed under the MIT License.", [("MIT", "modified", "-released")]),
        ("It is released under the MIT Licence", [("MIT", "exact", "")]),
        ("Copyright 2001. The text is available under the CC BY-SA 4.0 license", [("CC-BY-SA-4.0", "modified", "-licensed +the")]),
        ("All rights are hereby reserved; copyright of the owner", [("all-rights-reserved", "modified", "+are +hereby")]),
        ("Copyright 2001, some rights reserved", []),
        ("Licensed under the GNU Affero General Public License, version 3", []),
        ("This work is licensed under the GNU General Public License, version 4.", []),
        ("This work was licensed under the GNU General Public License, version 3.", [("GPL-3.0", "modified", "-is +was")]),
        ("This work is not licensed under the GNU General Public License, version 3.", []),
        ("Released under the BSD License. Released under the Apache License.", []),
        ("# SPDX-License-Identifier: MIT", [("MIT", "exact", "")]),
        ("/* SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR BSD-2-Clause */", [("GPL-2.0-only", "exact", ""), ("Linux-syscall-note", "exact", ""), ("BSD-2-Clause", "exact", "")]),
    ],
)
def test_short_statements(scanner, text, expected):
    assert found(scanner, text) == expected
