"""Usual wordings, standard headers and bodies of licenses, as templates beside the notices of ``licenses.NOTICES``.

Case and ASCII punctuation don't count. Fields to fill in, such as names and years, are left out.
"""

from __future__ import annotations

_NO_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""

_MIT = f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software. {_NO_WARRANTY} IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES
OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE
OR OTHER DEALINGS IN THE SOFTWARE."""

_BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""

_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING
IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to
in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations under the License."""

_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by
any means."""


def _gnu_header(kind: str, version: str) -> str:
    return f"""is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the
    Free Software Foundation, either version {version} of the License, or (at your option) any later version."""


def _gnu(kind: str, short: str, version: str, title: str) -> tuple[str, ...]:
    spdx = version if "." in version else f"{version}.0"
    return (
        f"licensed under the GNU {kind}, version {version}",
        f"GNU {kind} version {version}",
        f"GNU {kind} v{version}",
        f"version {version} of the GNU {kind}",
        f"GNU {short} version {version}",
        f"GNU {short} v{version}",
        f"the GNU {short}v{version}",
        f"the {short} version {version}",
        f"under {short} v{version}",
        f"the {short} v{version}",
        *([] if "." in version else [f"under the {short}v{version}", f"licensed under {short}v{version}"]),
        f"SPDX-License-Identifier: {short}-{spdx}",
        f"GNU {kind.upper()} {title}",
        _gnu_header(kind, version),
    )


def _creative_commons(parts: str, names: str) -> tuple[str, ...]:
    return (
        f"CC {parts} 4.0",
        f"Creative Commons {names} 4.0",
        f"creativecommons.org/licenses/{parts.lower()}/4.0",
        f"This work is licensed under a Creative Commons {names} 4.0 International License",
    )


#: By license, its templates besides the one in ``licenses.NOTICES``.
WORDINGS: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "under the Apache License, Version 2.0",
        "under the Apache 2.0 License",
        "under the Apache License 2.0",
        "under Apache License 2.0",
        "under the Apache-2.0 license",
        "under the terms of the Apache License, Version 2.0",
        "under the Apache Software License, Version 2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "Apache License Version 2.0, January 2004",
        _APACHE_HEADER,
    ),
    "MIT": (
        "under the MIT License",
        "under an MIT license",
        "under a MIT license",
        "under MIT license",
        "under the terms of the MIT License",
        "under the MIT/Expat License",
        "The MIT License (MIT)",
        "MIT License Copyright (c)",
        "SPDX-License-Identifier: MIT",
        _MIT,
    ),
    "GPL-2.0": _gnu("General Public License", "GPL", "2", "Version 2, June 1991"),
    "GPL-3.0": _gnu("General Public License", "GPL", "3", "Version 3, 29 June 2007"),
    "LGPL-2.1": _gnu("Lesser General Public License", "LGPL", "2.1", "Version 2.1, February 1999"),
    "LGPL-3.0": _gnu("Lesser General Public License", "LGPL", "3", "Version 3, 29 June 2007"),
    "AGPL-3.0": _gnu("Affero General Public License", "AGPL", "3", "Version 3, 19 November 2007"),
    "MPL-2.0": (
        "Mozilla Public License, Version 2.0",
        "Mozilla Public License 2.0",
        "Mozilla Public License, v. 2.0",
        "under the MPL 2.0",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY-4.0": _creative_commons("BY", "Attribution"),
    "CC-BY-SA-4.0": _creative_commons("BY-SA", "Attribution-ShareAlike"),
    "CC-BY-NC-4.0": _creative_commons("BY-NC", "Attribution-NonCommercial"),
    "CC-BY-ND-4.0": _creative_commons("BY-ND", "Attribution-NoDerivatives"),
    "CC-BY-NC-SA-4.0": _creative_commons("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "CC-BY-NC-ND-4.0": _creative_commons("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    "CC0-1.0": (
        "CC0 1.0 Universal",
        "under CC0 1.0",
        "creativecommons.org/publicdomain/zero/1.0",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "BSD-3-Clause": (
        "BSD 3-Clause License",
        "3-Clause BSD License",
        "under the BSD 3-Clause",
        "SPDX-License-Identifier: BSD-3-Clause",
        f"{_BSD_TERMS} {_BSD_NAMES} {_BSD_WARRANTY}",
    ),
    "BSD-2-Clause": (
        "BSD 2-Clause License",
        "2-Clause BSD License",
        "under the BSD 2-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
        f"{_BSD_TERMS} {_BSD_WARRANTY}",
    ),
    "ISC": (
        "under the ISC License",
        "SPDX-License-Identifier: ISC",
        f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_WARRANTY}",
    ),
    "0BSD": ("SPDX-License-Identifier: 0BSD", f"{_ISC_GRANT}. {_ISC_WARRANTY}"),
    "Unlicense": ("under the Unlicense", "SPDX-License-Identifier: Unlicense", _UNLICENSE),
    "all-rights-reserved": ("All rights reserved",),
}
