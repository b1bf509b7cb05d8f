"""Licence templates that the scan compares texts with."""

# Published licence texts, notices and short statements, by SPDX-style name.
TEMPLATES: dict[str, str] = {
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
    hereby granted. The software is provided "as is" and the author disclaims all warranties with regard to this
    software including all implied warranties of merchantability and fitness. In no event shall the author be liable
    for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use,
    data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in
    connection with the use or performance of this software.""",
    "AGPL-3.0-notice": """This program is free software: you can redistribute it and/or modify it under the terms of
    the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the
    License, or (at your option) any later version. This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
    PURPOSE. See the GNU Affero General Public License for more details.""",
    "Apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
    except in compliance with the License. You may obtain a copy of the License at
    http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
    distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
    either express or implied. See the License for the specific language governing permissions and limitations under
    the License.""",
    "Apache-2.0-statement": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
    provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
    notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
    above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
    materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS
    IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
    MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
    CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
    (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
    BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
    TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
    THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
    provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
    notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
    above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
    materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its
    contributors may be used to endorse or promote products derived from this software without specific prior written
    permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
    WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
    PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
    INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
    GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
    LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY
    OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the
    software and accompanying documentation covered by this license (the "Software") to use, reproduce, display,
    distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit
    third-parties to whom the Software is furnished to do so, all subject to the following:""",
    "CC-BY-4.0-statement": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-statement": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-statement": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0-statement": """To the extent possible under law, the author has dedicated all copyright and related and
    neighboring rights to this software to the public domain worldwide. This software is distributed without any
    warranty.""",
    "GPL-2.0-notice": """This program is free software; you can redistribute it and/or modify it under the terms of the
    GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at
    your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
    WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
    General Public License for more details.""",
    "GPL-3.0-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the
    GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
    your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
    WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
    General Public License for more details.""",
    "GPL-3.0-statement": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
    hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
    SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
    IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
    INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
    IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
    PERFORMANCE OF THIS SOFTWARE.""",
    "LGPL-2.1-notice": """This library is free software; you can redistribute it and/or modify it under the terms of
    the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the
    License, or (at your option) any later version. This library is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
    PURPOSE. See the GNU Lesser General Public License for more details.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
    associated documentation files (the "Software"), to deal in the Software without restriction, including without
    limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
    Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
    The above copyright notice and this permission notice shall be included in all copies or substantial portions of
    the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
    LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
    SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
    CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
    IN THE SOFTWARE.""",
    "MIT-statement": "Released under the MIT License.",
    "MPL-2.0-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
    of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
    modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
    binary, for any purpose, commercial or non-commercial, and by any means.""",
    "WTFPL": """Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and
    changing it is allowed as long as the name is changed.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
    be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
    software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to
    the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you
    wrote the original software. If you use this software in a product, an acknowledgment in the product documentation
    would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be
    misrepresented as being the original software. 3. This notice may not be removed or altered from any source
    distribution.""",
}

# Statements by licence and title, each in all wordings: a short statement shares too few word
# bigrams with another wording, or more with that of another version than with its own.
_WORDINGS = (
    "Licensed under the {}.",
    "Released under the {}.",
    "Distributed under the {}.",
    "This project is licensed under the {}.",
    "This work is licensed under the {}.",
    "This software is released under the {}.",
    "Licensed under the terms of the {}.",
    "Available under the {}.",
    "The code is available under the {}.",
)
_TITLES = {
    "0BSD": ["Zero-Clause BSD License"],
    "Apache-2.0": ["Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0 License"],
    "BSD": ["BSD License"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "BSL-1.0": ["Boost Software License 1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0"],
    "ISC": ["ISC License"],
    "MIT": ["MIT License"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, version 2.0"],
    "Unlicense": ["Unlicense"],
    "Zlib": ["zlib License"],
}
for _short, _kind, _versions in (("GPL", "", "23"), ("LGPL", "Lesser ", ("2.1", "3")), ("AGPL", "Affero ", "3")):
    for _v in _versions:
        _long = f"GNU {_kind}General Public License"
        _full = _v if "." in _v else f"{_v}.0"
        _TITLES[f"{_short}-{_full}"] = list(dict.fromkeys([f"{_long}, version {_v}", f"{_long} v{_full}", f"{_long}, version {_full}", f"{_short} v{_v}", f"{_short}v{_v}"]))
_STATEMENTS = {name: [w.format(t) for t in titles for w in _WORDINGS] for name, titles in _TITLES.items()}
for _short, _long in (
    ("BY", ""), ("BY-SA", "-ShareAlike"), ("BY-NC", "-NonCommercial"), ("BY-ND", "-NoDerivatives"),
    ("BY-NC-SA", "-NonCommercial-ShareAlike"), ("BY-NC-ND", "-NonCommercial-NoDerivatives"),
):
    for _v, _port in (("4.0", "International"), ("3.0", "Unported")):
        _title = f"Creative Commons Attribution{_long} {_v}"
        _STATEMENTS[f"CC-{_short}-{_v}"] = [
            f"Licensed under CC {_short} {_v}.",
            f"Licensed under a {_title} {_port} License.",
            f"This work is licensed under a {_title} {_port} License.",
            f"This work is licensed under a {_title} License.",
        ]
for _name in _TITLES:
    # tags in source files; licences of the GNU family name how later versions count
    _tags = [f"{_name}-only", f"{_name}-or-later"] if "GPL" in _name else [_name]
    _STATEMENTS[_name] += [f"SPDX-License-Identifier: {_tag}" for _tag in _tags]
_STATEMENTS["CC-BY-4.0"].append("This work is licensed under CC BY 4.0.")
_STATEMENTS["CC-BY-3.0"].append("This work is licensed under CC BY 3.0.")

_GPL3, _LGPL2 = TEMPLATES["GPL-3.0-notice"], TEMPLATES["LGPL-2.1-notice"]
TEMPLATES["LGPL-3.0-notice"] = _GPL3.replace("General Public", "Lesser General Public")
TEMPLATES["LGPL-2.0-notice"] = _LGPL2.replace("Lesser", "Library").replace("version 2.1", "version 2")
_had = {" ".join(t.lower().split()) for t in TEMPLATES.values()}
for _name, _texts in _STATEMENTS.items():
    for _k, _text in enumerate(_texts, 1):
        # the first ones keep their names
        if _text.lower() not in _had:
            _key = f"{_name}-statement"
            TEMPLATES[_key if _key not in TEMPLATES else f"{_key}-{_k}"] = _text
