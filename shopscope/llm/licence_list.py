"""Notices, headers and full texts of well-known public licences, as templates of the licence scan.

Notices are the usual phrasings around the name and the abbreviation of each licence and version. Short full texts stand here, long
ones (of more than a few hundred words) in ``licence_texts``. The full text of the AGPL differs from that of the GPL in one section and is found as that.
"""

from __future__ import annotations

from pathlib import Path

MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
MIT_REST = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
MIT_DISCLAIMER = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
BSD_CLAUSES = [
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
]
BSD_DISCLAIMER = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
ISC_DISCLAIMER = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
APACHE_HEADER = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
APACHE_REST = "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
MPL_HEADER = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."

#: Names a notice may use, by licence; a name with "License" in it takes an article.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache 2.0", "Apache License 2.0", "Apache-2.0 license"],
    "Apache-1.1": ["Apache License, Version 1.1"],
    "MIT": ["MIT License", "MIT"],
    "BSD": ["BSD License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License", "two-clause BSD license"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License", "three-clause BSD license"],
    "BSD-4-Clause": ["BSD 4-Clause License"],
    "ISC": ["ISC License"],
    "Zlib": ["zlib License"],
    "BSL-1.0": ["Boost Software License, Version 1.0"],
    "MPL-1.1": ["Mozilla Public License, version 1.1", "MPL 1.1"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "EPL-1.0": ["Eclipse Public License, version 1.0", "EPL 1.0"],
    "EPL-2.0": ["Eclipse Public License, version 2.0", "EPL 2.0"],
    "CDDL-1.0": ["Common Development and Distribution License, version 1.0"],
    "EUPL-1.2": ["European Union Public Licence, version 1.2"],
    "Artistic-2.0": ["Artistic License 2.0"],
    "OFL-1.1": ["SIL Open Font License, Version 1.1"],
    "WTFPL": ["Do What The Fuck You Want To Public License"],
    "Unlicense": ["Unlicense"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal License"],
    "GFDL-1.2": ["GNU Free Documentation License, version 1.2"],
    "GFDL-1.3": ["GNU Free Documentation License, version 1.3"],
}
GNU = {
    "GPL": ("GNU General Public License", ["1", "2", "3"]),
    "LGPL": ("GNU Lesser General Public License", ["2.1", "3"]),
    "LGPL-library": ("GNU Library General Public License", ["2"]),
    "AGPL": ("GNU Affero General Public License", ["3"]),
}
CC = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
CC_VERSIONS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic"}
FORMS = {
    "licensed": "Licensed under {}.", "released": "Released under {}.", "distributed": "Distributed under {}.", "work": "This work is licensed under {}.",
    "project": "This project is licensed under {}.",
}


def _notices() -> dict[str, str]:
    names = {key: list(found) for key, found in NAMES.items()}
    for key, (name, versions) in GNU.items():
        short = key.split("-")[0]
        for v in versions:
            names[f"{key}-{v}"] = [f"{name}, version {v}", f"{name} v{v}", f"{name}, version {v} or later", f"{short} v{v}", f"{short}v{v}", f"{short} version {v}", f"{short} {v}.0" if "." not in v else f"{short} {v}"]
    for key, name in CC.items():
        for v, area in CC_VERSIONS.items():
            names[f"CC-{key}-{v}"] = [f"CC {key} {v}", f"Creative Commons {name} {v} {area} License", f"Creative Commons {name} {v} License", f"Creative Commons {name} {v}"]
    out = {}
    for key, found in names.items():
        for k, name in enumerate(found):
            article = "" if name.startswith("CC") else "a " if name.startswith("Creative") else "the "
            for form, text in FORMS.items():
                out[f"{key}-{form}-{k}"] = text.format(article + name)
                if article == "the ":
                    out[f"{key}-{form}-{k}-bare"] = text.format(name)
        out[f"{key}-spdx"] = f"SPDX-License-Identifier: {key}"
    return out


def _gnu_headers() -> dict[str, str]:
    out = {}
    for key, (name, versions) in GNU.items():
        for kind in ("program", "library", "file"):
            for v in versions:
                grant = f"This {kind} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version."
                waiver = f"This {kind} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
                copy = f"You should have received a copy of the {name} along with this {kind}. If not, see <https://www.gnu.org/licenses/>."
                out[f"{key}-{v}-grant-{kind}"] = grant
                out[f"{key}-{v}-grant-only-{kind}"] = grant.replace("either version", "version").replace(", or (at your option) any later version", "")
                out[f"{key}-{v}-header-{kind}"] = f"{grant} {waiver} {copy}"
            out[f"{key}-waiver-{kind}"], out[f"{key}-copy-{kind}"] = waiver, copy
    return out


MORE = {
    **_notices(),
    **_gnu_headers(),
    "Apache-2.0-full-header": f"{APACHE_HEADER} {APACHE_REST}",
    "Apache-2.0-disclaimer": APACHE_REST,
    "MIT-see": "This project is licensed under the MIT License - see the LICENSE file for details.",
    "MIT-use": "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file.",
    "MIT-condition": MIT_REST,
    "MIT-disclaimer": MIT_DISCLAIMER,
    "MIT-text": f"{MIT_GRANT} {MIT_REST} {MIT_DISCLAIMER}",
    "BSD-use": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-source-clause": BSD_CLAUSES[0],
    "BSD-binary-clause": BSD_CLAUSES[1],
    "BSD-name-clause": BSD_CLAUSES[2],
    "BSD-disclaimer": BSD_DISCLAIMER,
    "BSD-2-Clause-text": " ".join([BSD_GRANT, *BSD_CLAUSES[:2], BSD_DISCLAIMER]),
    "BSD-3-Clause-text": " ".join([BSD_GRANT, *BSD_CLAUSES, BSD_DISCLAIMER]),
    "ISC-text": f"{ISC_GRANT} {ISC_DISCLAIMER}",
    "CC0-1.0-waiver": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense-dedication": "This is free and unencumbered software released into the public domain.",
    "public-domain": "This work is in the public domain.",
    "Zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
}

#: Full texts, compared only with passages of at least two thirds of their bigrams.
TEXTS = {f"{p.stem}-text": p.read_text(encoding="utf-8") for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}
