"""License statements as they stand in files and on pages, with the labels that they mean."""

LINES = """
mit | Licensed under the MIT License.
mit | Licensed under the MIT license (see LICENSE file).
mit | This project is licensed under the terms of the MIT license.
mit | Released under the MIT License
mit | Distributed under the MIT License. See `LICENSE.txt` for more information.
mit | The code is available under the MIT license.
mit | License: MIT
mit | SPDX-License-Identifier: MIT
mit | // SPDX-License-Identifier: MIT
mit | https://opensource.org/licenses/MIT
mit | https://opensource.org/license/mit/
mit | Permission is hereby granted, free of charge, to any person obtaining a copy of this software
mit | The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
mit-0 | SPDX-License-Identifier: MIT-0
mit-0 | Licensed under the MIT No Attribution license
apache-2 | Licensed under the Apache License, Version 2.0 (the "License");
apache-2 | Licensed under the Apache License v2.0
apache-2 | Licensed under the Apache License 2.0
apache-2 | Licensed under Apache 2.0
apache-2 | Licensed under the Apache-2.0 license
apache-2 | Licensed under Apache License, version 2
apache-2 | Released under the Apache 2.0 license.
apache-2 | Distributed under the Apache License, Version 2.0
apache-2 | SPDX-License-Identifier: Apache-2.0
apache-2 | http://www.apache.org/licenses/LICENSE-2.0
apache-2 | See the License for the specific language governing permissions and limitations under the License.
apache-2 | This software is available under the Apache Software License 2.0.
apache,apache-2 | License :: Apache Software License v2
apache-1.1 | SPDX-License-Identifier: Apache-1.1
apache-1.1 | Licensed under the Apache Software License, Version 1.1
apache | Licensed under the Apache license
bsd | Licensed under the BSD license
bsd | Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.
bsd | Redistribution and use in source and binary forms, with or without modification, are permitted
bsd | Released under the BSD license.
bsd-2-clause | SPDX-License-Identifier: BSD-2-Clause
bsd-2-clause | Licensed under the Simplified BSD License
bsd-2-clause | Distributed under the 2-clause BSD license
bsd-2-clause | https://opensource.org/licenses/BSD-2-Clause
bsd-3-clause | SPDX-License-Identifier: BSD-3-Clause
bsd-3-clause | Licensed under the New BSD license.
bsd-3-clause | This code is licensed under the 3-Clause BSD License
bsd-3-clause | Released under the revised BSD license
bsd-3-clause | Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
bsd-4-clause | All advertising materials mentioning features or use of this software must display the following acknowledgement
bsd-4-clause | SPDX-License-Identifier: BSD-4-Clause
0bsd | SPDX-License-Identifier: 0BSD
isc | SPDX-License-Identifier: ISC
isc | Licensed under the ISC license
isc | Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted
gpl | licensed under the GPL
gpl | Licensed under the GNU GPL
gpl | This program is free software: you can redistribute it and/or modify it
gpl | You should have received a copy of the GNU General Public License along with this program.
gpl | Released under the GNU General Public License.
gpl | see <https://www.gnu.org/licenses/gpl.html>
gpl-2 | SPDX-License-Identifier: GPL-2.0
gpl-2 | SPDX-License-Identifier: GPL-2.0-only
gpl-2 | SPDX-License-Identifier: GPL-2.0-or-later
gpl-2 | Licensed under the GPLv2
gpl-2 | Licensed under the GNU General Public License v2.0
gpl-2 | Licensed under the GNU General Public License version 2
gpl-2 | Distributed under the terms of the GNU General Public License v2
gpl-2 | either version 2 of the License, or (at your option) any later version
gpl-2 | https://www.gnu.org/licenses/old-licenses/gpl-2.0.html
gpl-3 | SPDX-License-Identifier: GPL-3.0-or-later
gpl-3 | Licensed under the GPL v3
gpl-3 | Licensed under GPL-3.0
gpl-3 | Licensed under the GNU GPL version 3
gpl-3 | Licensed under the GNU General Public License, version 3
gpl-3 | either version 3 of the License, or (at your option) any later version.
gpl-3 | https://www.gnu.org/licenses/gpl-3.0.en.html
lgpl | Licensed under the LGPL
lgpl | Licensed under the GNU Lesser General Public License
lgpl-2 | SPDX-License-Identifier: LGPL-2.0-only
lgpl-2.1 | SPDX-License-Identifier: LGPL-2.1-or-later
lgpl-2.1 | Licensed under the LGPL v2.1
lgpl-2.1 | https://www.gnu.org/licenses/old-licenses/lgpl-2.1.html
lgpl-3 | Licensed under the GNU Lesser General Public License v3.0
lgpl-3 | SPDX-License-Identifier: LGPL-3.0-only
agpl | Licensed under the AGPL
agpl-3 | SPDX-License-Identifier: AGPL-3.0-only
agpl-3 | Licensed under the AGPLv3
agpl-3 | Licensed under the GNU Affero General Public License v3.0
agpl-3 | https://www.gnu.org/licenses/agpl-3.0.html
gfdl-1.3 | SPDX-License-Identifier: GFDL-1.3-or-later
gfdl | the terms of the GNU Free Documentation License
mpl-2 | SPDX-License-Identifier: MPL-2.0
mpl-2 | Licensed under the Mozilla Public License 2.0
mpl-2 | Licensed under the MPL 2.0
mpl-2 | If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.
mpl-1.1 | Licensed under the Mozilla Public License Version 1.1
mpl | Licensed under the Mozilla Public License
epl-1 | SPDX-License-Identifier: EPL-1.0
epl-1 | http://www.eclipse.org/legal/epl-v10.html
epl-2 | Licensed under the Eclipse Public License 2.0
epl-2 | SPDX-License-Identifier: EPL-2.0
cddl-1 | SPDX-License-Identifier: CDDL-1.0
cddl-1 | Licensed under the CDDL 1.0
cddl-1 | subject to the terms of the Common Development and Distribution License
eupl-1.2 | Licensed under the EUPL v1.2
eupl-1.2 | SPDX-License-Identifier: EUPL-1.2
artistic-2 | SPDX-License-Identifier: Artistic-2.0
artistic-2 | Licensed under the Artistic License 2.0
artistic-2 | Licensed under the Artistic License v2.0
bsl-1 | SPDX-License-Identifier: BSL-1.0
bsl-1 | Distributed under the Boost Software License, Version 1.0.
bsl-1 | http://www.boost.org/LICENSE_1_0.txt
busl-1.1 | Licensed under the Business Source License 1.1
busl-1.1 | SPDX-License-Identifier: BUSL-1.1
sspl-1 | Licensed under the Server Side Public License, v 1
sspl-1 | Licensed under SSPL
sspl-1 | SPDX-License-Identifier: SSPL-1.0
elastic-2 | Licensed under the Elastic License 2.0
ms-pl | Licensed under the Microsoft Public License
ms-pl | SPDX-License-Identifier: MS-PL
zlib | Licensed under the zlib license
zlib | SPDX-License-Identifier: Zlib
unlicense | Released under the Unlicense
unlicense | This is free and unencumbered software released into the public domain.
unlicense | For more information, please refer to <https://unlicense.org>
wtfpl | Licensed under the WTFPL
wtfpl | DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
postgresql | Licensed under the PostgreSQL License
python-2 | Licensed under the Python Software Foundation License
python-2 | SPDX-License-Identifier: PSF-2.0
php-3 | Licensed under the PHP License v3.01
openssl | Licensed under the OpenSSL license
ofl-1.1 | This Font Software is licensed under the SIL Open Font License, Version 1.1.
ofl-1.1 | https://scripts.sil.org/OFL
odbl-1 | Licensed under the ODbL 1.0
odbl-1 | made available under the Open Database License
cc0-1 | Released under CC0 1.0 Universal
cc0-1 | https://creativecommons.org/publicdomain/zero/1.0/
cc-by | This work is licensed under a Creative Commons Attribution 4.0 International License.
cc-by | Licensed under CC BY 4.0
cc-by | SPDX-License-Identifier: CC-BY-4.0
cc-by | https://creativecommons.org/licenses/by/4.0/
cc-by-sa | This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.
cc-by-sa | Licensed under CC BY-SA 3.0
cc-by-sa | https://creativecommons.org/licenses/by-sa/3.0/
cc-by-nd | Licensed under CC-BY-ND 4.0
cc-by-nc | This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.
cc-by-nc | https://creativecommons.org/licenses/by-nc/4.0/
cc-by-nc-sa | This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.
cc-by-nc-nd | Licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License
cc | Licensed under a Creative Commons license
mit,apache-2 | SPDX-License-Identifier: MIT OR Apache-2.0
mit,apache-2 | Licensed under either of the MIT and Apache 2.0 licenses
mit,gpl-2 | dual licensed under MIT and GPL v2
gpl-2,mit | SPDX-License-Identifier: GPL-2.0-only OR MIT
apache-2,bsd-3-clause,mit | SPDX-License-Identifier: (MIT AND BSD-3-Clause) OR Apache-2.0
apache-2,mit | MIT and Apache 2.0 licenses
llama | Licensed under the Llama 2 Community License
openrail | Released under the CreativeML OpenRAIL-M license
proprietary | Copyright 2020 Example Corp. All rights reserved.
 | The licensing board met under the bridge.
 | A poetic license is no excuse.
 | The driver lost his license in Apache County.
"""


def cases():
    """(labels, line)."""
    found = []
    for line in LINES.strip("\n").split("\n"):
        labels, text = line.split("|", 1)
        found.append((sorted(filter(None, labels.strip().split(","))), text.strip()))
    return found
