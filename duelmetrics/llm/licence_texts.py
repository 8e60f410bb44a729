"""Known licence texts and notices (fixed values, public texts)."""

from __future__ import annotations

from importlib.resources import files

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so"""
_MIT_NOTICE = """The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
_MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted"""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
_BSD_TWO = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
_MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""

#: Whole licences and standard headers.
TEXTS = {
    "MIT": f"{_MIT_GRANT}, subject to the following conditions:\n\n{_MIT_NOTICE}\n\n{_MIT_WARRANTY}",
    "MIT-0": f"{_MIT_GRANT}.\n\n{_MIT_WARRANTY}",
    "ISC": f"{_ISC_GRANT}, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\n{_ISC_WARRANTY}",
    "0BSD": f"{_ISC_GRANT}.\n\n{_ISC_WARRANTY}",
    "BSD-2-Clause": f"{_BSD_TWO}\n\n{_BSD_WARRANTY}",
    "BSD-3-Clause": f"{_BSD_TWO}\n\n{_BSD_THIRD}\n\n{_BSD_WARRANTY}",
    "Zlib": _ZLIB,
    "Apache-2.0": _APACHE_HEADER,
    "MPL-2.0": _MPL_HEADER,
}

#: Long texts, in files of this name beside this module; what follows the END of some,
#: instructions for use, a copy may leave out.
LONG = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"]
END = "END OF TERMS AND CONDITIONS"

#: Titles above a licence; its file has one, or none.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT"],
    "MIT-0": ["MIT No Attribution", "MIT No Attribution License", "MIT-0"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)", "0BSD"],
    "BSD-2-Clause": [
        "BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", "2-Clause BSD License",
        "Simplified BSD License", 'BSD 2-Clause "Simplified" License', "BSD License", "The BSD License",
    ],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", "3-Clause BSD License",
        "New BSD License", "Modified BSD License", "Revised BSD License",
        'BSD 3-Clause "New" or "Revised" License', "BSD License", "The BSD License",
    ],
    "Zlib": ["zlib License", "The zlib License", "The zlib/libpng License", "zlib/libpng License"],
}


def _gnu(identifier: str) -> list[str]:
    """The forms of an SPDX identifier that say whether later versions count."""
    return [f"{identifier}-only", f"{identifier}-or-later"]


#: Names by which notices call a licence.
NAMES = {
    "MIT": ["MIT License", "MIT"],
    "ISC": ["ISC License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "GPL-2.0": ["GNU General Public License, version 2", "GPL version 2", "GPLv2", *_gnu("GPL-2.0")],
    "GPL-3.0": ["GNU General Public License, version 3", "GPL version 3", "GPLv3", *_gnu("GPL-3.0")],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "LGPLv2.1", *_gnu("LGPL-2.1")],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPLv3", *_gnu("LGPL-3.0")],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPLv3", *_gnu("AGPL-3.0")],
    "MPL-2.0": ["Mozilla Public License, version 2.0"],
    "MIT-0": [],
    "0BSD": [],
    "Zlib": ["zlib License"],
    "CC0-1.0": ["CC0 1.0"],
    "CC-BY-4.0": ["CC BY 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
}
#: Sentences of a notice.
SENTENCES = [
    "Licensed under {}.",
    "Licensed under the {}.",
    "Released under the {}.",
    "Distributed under the {}.",
    "This work is licensed under the {}.",
    "This work is licensed under {}.",
    "This software is released under the {}.",
    "SPDX-License-Identifier: {}",
]


def texts() -> list[tuple[str, str]]:
    """(licence, text): short texts with and without titles and numbers of clauses, long ones whole."""
    found = list(TEXTS.items())
    found += [
        (x, "\n".join(line.removeprefix(f"{n}. ") for n, line in _numbered(TEXTS[x])))
        for x in ("BSD-2-Clause", "BSD-3-Clause")
    ]
    found += [(x, f"{title}\n\n{text}") for x, text in found for title in TITLES.get(x, [])]
    for licence in LONG:
        text = (files(__package__) / "licences" / f"{licence}.txt").read_text(encoding="utf-8")
        found.append((licence, text))
        if END in text:
            terms = text[: text.index(END)]
            found += [(licence, terms), (licence, f"{terms}{END}")]
    return found


def _numbered(text: str) -> list[tuple[str, str]]:
    """Each line and the digit that it begins with."""
    return [(line[:1], line) for line in text.split("\n")]


def known() -> list[tuple[str, str]]:
    """(licence, text) of every known text and notice; identifiers themselves make notices too."""
    notices = [
        (licence, sentence.format(name))
        for licence, names in NAMES.items()
        for name in [*names, licence]
        for sentence in SENTENCES
    ]
    return [*texts(), *notices]
