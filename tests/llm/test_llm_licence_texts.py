"""Licences as files and notices have them, with their own holders' names and line breaks."""

import pytest

from aerolith.llm import licences

BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

   * Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer.
   * Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or
other materials provided with the distribution.
"""
NAMES = """   * Neither the name of {} nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission.
"""
NOTICE = """    {} is free software; you can redistribute it and/or modify
    it under the terms of the GNU {} Public License as published by
    the Free Software Foundation; either version {} of the License, or
    (at your option) any later version.

    {} is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
"""


@pytest.mark.parametrize("text, names", [
    (BSD + NAMES.format("Google Inc."), ["BSD-3-Clause"]),
    (BSD + NAMES.format("the University of California, Berkeley"), ["BSD-3-Clause"]),
    (BSD + NAMES.format("the copyright holder"), ["BSD-3-Clause"]),
    (BSD + NAMES.format("A. B. C. D. E. F. G. H. I. J. K. Lab of the U. of X; a.k.a. L. M. N. O."), ["BSD-3-Clause"]),
    (BSD + NAMES.format("the copyright holder") + "\nNeither the name of it.\n" * 3000, ["BSD-3-Clause"]),
    ("Neither the name of that. " + BSD + "nor the names of anybody.", ["BSD-2-Clause"]),
    (BSD, ["BSD-2-Clause"]),
    (NOTICE.format("This program", "General", "2", "This program"), ["GPL-2.0-or-later"]),
    (NOTICE.format("GNU Foo 2", "General", "3", "GNU Foo 2"), ["GPL-3.0-or-later"]),
    (NOTICE.format("This library", "Lesser General", "2.1", "This library"), ["LGPL-2.1-or-later"]),
    (NOTICE.format("This program", "Affero General", "3", "It"), ["AGPL-3.0-or-later"]),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy", ["MPL-2.0"]),
    ("This is free and unencumbered software released into the public domain.\n", ["Unlicense"]),
    ("Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n", ["Zlib"]),
    ("This work is licensed under CC BY-ND 4.0.", ["CC-BY-ND-4.0"]),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License.", ["CC-BY-NC-SA-3.0"]),
    ("This project is licensed under the MIT License - see the [LICENSE](LICENSE) file for details.", ["MIT"]),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n", ["GPL-2.0-only"]),
    ("Licensed under the GNU General Public License version 2 or later.", ["GPL-2.0-or-later"]),
    ("It is not said that it is licensed under the MIT License.", []),
])
def test_real_texts(text, names):
    scanner = licences.Scanner(licences.SENTENCES, licences.RULES, licences.MAX_GAP)
    assert [m[0] for m in scanner.scan_text(text)] == names
