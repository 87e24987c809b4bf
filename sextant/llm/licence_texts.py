"""Texts that declare a licence. All of this module are fixed values: the wording of
the licences, and identifiers of the SPDX list."""

from __future__ import annotations

#: Short notices, one line each.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "BSD-3-Clause": "Released under the BSD 3-Clause License",
    "MPL-2.0": "This work is subject to the terms of the Mozilla Public License, v. 2.0",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "All-Rights-Reserved": "All rights reserved",
}

#: Identifiers that stand behind ``SPDX-License-Identifier:``, by the licence they name.
IDENTIFIERS = {
    "Apache-2.0": ["Apache-2.0"],
    "MIT": ["MIT"],
    "ISC": ["ISC"],
    "BSD-2-Clause": ["BSD-2-Clause"],
    "BSD-3-Clause": ["BSD-3-Clause"],
    "GPL-2.0": ["GPL-2.0", "GPL-2.0+", "GPL-2.0-only", "GPL-2.0-or-later"],
    "GPL-3.0": ["GPL-3.0", "GPL-3.0+", "GPL-3.0-only", "GPL-3.0-or-later"],
    "LGPL-2.1": ["LGPL-2.1", "LGPL-2.1+", "LGPL-2.1-only", "LGPL-2.1-or-later"],
    "LGPL-3.0": ["LGPL-3.0", "LGPL-3.0+", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "AGPL-3.0": ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"],
    "MPL-2.0": ["MPL-2.0"],
    "CC-BY-4.0": ["CC-BY-4.0"],
    "CC-BY-SA-4.0": ["CC-BY-SA-4.0"],
    "CC-BY-NC-4.0": ["CC-BY-NC-4.0"],
    "Unlicense": ["Unlicense"],
}

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

_BSD_GRANT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""

_BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""

_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means."""

_MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""

# the notice that the GNU licences ask for; what differs is the licence and its version
_GNU_HEADER = """This program is free software: you can redistribute it and/or modify
it under the terms of the {licence} as published by
the Free Software Foundation, either version {version} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
{licence} for more details.

You should have received a copy of the {licence}
along with this program.  If not, see <https://www.gnu.org/licenses/>."""

_GNU_TITLE = """{licence}
Version {version}, {date}

Copyright (C) {year} Free Software Foundation, Inc. <https://fsf.org/>
Everyone is permitted to copy and distribute verbatim copies
of this license document, but changing it is not allowed."""

_GNU = [
    ("GPL-2.0", "GNU General Public License", "2", "June 1991", "1989, 1991"),
    ("GPL-3.0", "GNU General Public License", "3", "29 June 2007", "2007"),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1", "February 1999", "1991, 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3", "29 June 2007", "2007"),
    ("AGPL-3.0", "GNU Affero General Public License", "3", "19 November 2007", "2007"),
]

#: Whole licences, the openings of those that fill pages, and header blocks.
TEXTS = [
    ("MIT", _MIT),
    ("ISC", _ISC),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_END),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_NAMES + _BSD_END),
    ("Apache-2.0", _APACHE_HEADER),
    ("Apache-2.0", "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/"),
    ("MPL-2.0", _MPL_HEADER),
    ("MPL-2.0", "Mozilla Public License Version 2.0\n==================================\n\n1. Definitions"),
    ("Unlicense", _UNLICENSE),
    *[(name, _GNU_HEADER.format(licence=licence, version=version)) for name, licence, version, _, _ in _GNU],
    *[(name, _GNU_TITLE.format(licence=licence, version=version, date=date, year=year))
      for name, licence, version, date, year in _GNU],
]


def standard_templates() -> list[tuple[str, str]]:
    """(licence, text) of all notices, identifier lines, headers and licences."""
    return ([*NOTICES.items()] + [(name, f"SPDX-License-Identifier: {i}") for name, ids in IDENTIFIERS.items() for i in ids]
            + TEXTS)
