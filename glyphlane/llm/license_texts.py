"""Known licence texts and notices: fixed values that must read as published."""

from __future__ import annotations

from pathlib import Path

#: Whole licences as published, one file each, named by their ids.
FOLDER = Path(__file__).parent / "licenses"
#: What follows this line of a licence tells how to apply it and may be left out.
END_OF_TERMS = "END OF TERMS AND CONDITIONS"

_PERMISSION = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
)
_SOFTWARE_IS_PROVIDED = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_REDISTRIBUTION = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
_NO_ENDORSEMENT = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.\n\n"
)
_PROVIDED_BY_HOLDERS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions:\n\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    "Software.\n\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
    "any damages arising from the use of this software.\n\n"
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
    "redistribute it freely, subject to the following restrictions:\n\n"
    "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you "
    "use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n\n"
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n\n"
    "3. This notice may not be removed or altered from any source distribution."
)
_ISC = (
    f"{_PERMISSION}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_SOFTWARE_IS_PROVIDED}"
)

#: Whole licences, each with and without its title.
TEXTS = [
    ("MIT", "MIT License", _MIT),
    ("ISC", "ISC License", _ISC),
    ("0BSD", "BSD Zero Clause License", f"{_PERMISSION}.\n\n{_SOFTWARE_IS_PROVIDED}"),
    ("BSD-2-Clause", "BSD 2-Clause License", _REDISTRIBUTION + _PROVIDED_BY_HOLDERS),
    ("BSD-3-Clause", "BSD 3-Clause License", _REDISTRIBUTION + _NO_ENDORSEMENT + _PROVIDED_BY_HOLDERS),
    ("Zlib", "zlib License", _ZLIB),
]

#: Names of licences as notices spell them.
NAMES = [
    ("Apache-2.0", "the Apache License, Version 2.0"),
    ("Apache-2.0", "the Apache License 2.0"),
    ("MIT", "the MIT License"),
    ("GPL-2.0-only", "the GNU General Public License, version 2"),
    ("GPL-3.0-only", "the GNU General Public License, version 3"),
    ("LGPL-3.0-only", "the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0-only", "the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "the Mozilla Public License, version 2.0"),
    ("BSD-2-Clause", "the BSD 2-Clause License"),
    ("BSD-3-Clause", "the BSD 3-Clause License"),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "CC BY-ND 4.0"),
    ("CC0-1.0", "CC0 1.0"),
]
OPENINGS = ["Licensed under", "Released under", "This work is licensed under", "This software is licensed under", "Distributed under"]


def known_texts() -> list[tuple[str, str]]:
    """Licence id and text: whole licences, one-sentence notices, identifier tags."""
    whole = [(i, body) for i, _, body in TEXTS] + [(i, f"{title}\n\n{body}") for i, title, body in TEXTS]
    for path in sorted(FOLDER.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        terms, mark, _ = text.partition(END_OF_TERMS)
        whole += [(path.stem, text), *([(path.stem, terms), (path.stem, terms + mark)] if mark else [])]
    notices = [(i, f"{opening} {name}.") for i, name in NAMES for opening in OPENINGS]
    tags = [(i, f"SPDX-License-Identifier: {i}") for i in sorted({i for i, _ in whole} | {i for i, _ in NAMES})]
    return [*whole, *notices, *tags, ("LicenseRef-all-rights-reserved", "All rights reserved.")]
