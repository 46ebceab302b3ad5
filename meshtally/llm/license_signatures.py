"""License signatures: hand-written patterns over words, in their order.

A line is `label keyword: pattern`. The pattern runs over lower-cased words with one blank
between them; every match holds the keyword as a word. Earlier groups outrank later ones.
"""

from __future__ import annotations

# Level 0: notices, grants and tags that name one license in full.
NOTICES = r"""
apache-2.0 apache: licensed under the apache license version 2( 0)?
apache-2.0 apache: licensed under apache (license )?(version |v )?2( 0)?
apache-2.0 apache: distributed under the (terms of the )?apache license( version)? 2( 0)?
apache-2.0 apache: www apache org licenses license 2 0
apache-2.0 apache: spdx license identifier apache 2 0
apache-1.1 apache: spdx license identifier apache 1 1
mit mit: released under the (terms of the )?mit license
mit mit: licensed under the (terms of the )?mit license
mit mit: distributed under the (terms of the )?mit license
mit mit: available under the (terms of the )?mit license
mit mit: (is|are) mit licensed
mit mit: spdx license identifier mit
mit mit: opensource org licenses mit( license)?
mit charge: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit substantial: the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit-0 mit: spdx license identifier mit 0
isc isc: (released|licensed|distributed) under the (terms of the )?isc license
isc isc: spdx license identifier isc
isc fee: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
0bsd 0bsd: spdx license identifier 0bsd
bsd bsd: (released|licensed|distributed) under the (terms of the )?bsd license
bsd-2-clause bsd: (released|licensed|distributed) under the (terms of the )?(bsd 2 clause|2 clause bsd|simplified bsd) license
bsd-3-clause bsd: (released|licensed|distributed) under the (terms of the )?(bsd 3 clause|3 clause bsd|new bsd|modified bsd) license
bsd-2-clause bsd: spdx license identifier bsd 2 clause
bsd-3-clause bsd: spdx license identifier bsd 3 clause
bsd-4-clause bsd: spdx license identifier bsd 4 clause
bsd redistributions: redistributions of source code must retain the above copyright notice
bsd redistributions: redistributions in binary form must reproduce the above copyright notice
bsd redistribution: redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause endorse: may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause advertising: all advertising materials mentioning features or use of this software must display the following
gpl-1.0 gnu: licensed under the (terms of the )?gnu general public license (version |v )?1( 0)?
gpl-2.0 gnu: licensed under the (terms of the )?gnu general public license (version |v )?2( 0)?
gpl-3.0 gnu: licensed under the (terms of the )?gnu general public license (version |v )?3( 0)?
gpl-1.0 gpl: spdx license identifier gpl 1 0( only| or later)?
gpl-2.0 gpl: spdx license identifier gpl 2 0( only| or later)?
gpl-3.0 gpl: spdx license identifier gpl 3 0( only| or later)?
gpl-2.0 gnu: terms of the gnu general public license as published by the free software foundation either version 2
gpl-3.0 gnu: terms of the gnu general public license as published by the free software foundation either version 3
gpl-2.0 gnu: gnu general public license version 2 as published by the free software foundation
gpl-3.0 gnu: gnu general public license version 3 as published by the free software foundation
gpl gnu: you should have received a copy of the gnu general public license
gpl gnu: www gnu org licenses gpl( html)?
lgpl-2.0 lgpl: spdx license identifier lgpl 2 0( only| or later)?
lgpl-2.1 lgpl: spdx license identifier lgpl 2 1( only| or later)?
lgpl-3.0 lgpl: spdx license identifier lgpl 3 0( only| or later)?
lgpl-2.1 lesser: licensed under the (terms of the )?gnu lesser general public license (version |v )?2 1
lgpl-3.0 lesser: licensed under the (terms of the )?gnu lesser general public license (version |v )?3( 0)?
lgpl lesser: you should have received a copy of the gnu lesser general public license
lgpl gnu: www gnu org licenses lgpl( html)?
agpl-3.0 agpl: spdx license identifier agpl 3 0( only| or later)?
agpl-3.0 affero: licensed under the (terms of the )?gnu affero general public license (version |v )?3( 0)?
agpl affero: you should have received a copy of the gnu affero general public license
agpl gnu: www gnu org licenses agpl( html)?
gfdl free: permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl gfdl: spdx license identifier gfdl 1 [1-3]( only| or later)?
mpl-1.1 mpl: spdx license identifier mpl 1 1
mpl-2.0 mpl: spdx license identifier mpl 2 0
mpl-2.0 mozilla: subject to the terms of the mozilla public license v 2 0
mpl-2.0 mozilla: (released|licensed|distributed) under the (terms of the )?mozilla public license (version |v )?2( 0)?
mpl-1.1 mozilla: subject to the mozilla public license version 1 1
mpl-2.0 mozilla: mozilla org mpl 2 0
epl-1.0 eclipse: made available under the terms of the eclipse public license v(ersion)? 1 0
epl-2.0 eclipse: made available under the terms of the eclipse public license v(ersion)? 2 0
epl-1.0 epl: spdx license identifier epl 1 0
epl-2.0 epl: spdx license identifier epl 2 0
cddl-1.0 cddl: spdx license identifier cddl 1 0
cddl-1.0 development: subject to the terms of the common development and distribution license
eupl-1.1 eupl: (licensed under the|spdx license identifier) eupl (version )?1 1
eupl-1.2 eupl: (licensed under the|spdx license identifier) eupl (version )?1 2
bsl-1.0 boost: distributed under the boost software license version 1 0
bsl-1.0 bsl: spdx license identifier bsl 1 0
busl-1.1 busl: spdx license identifier busl 1 1
unlicense unencumbered: this is free and unencumbered software released into the public domain
unlicense unlicense: spdx license identifier unlicense
wtfpl wtfpl: spdx license identifier wtfpl
zlib zlib: spdx license identifier zlib
zlib misrepresented: the origin of this software must not be misrepresented
cc0-1.0 cc0: spdx license identifier cc0 1 0
cc0-1.0 publicdomain: creativecommons org publicdomain zero 1 0
cc-by-1.0 creativecommons: creativecommons org licenses by 1 0
cc-by-2.0 creativecommons: creativecommons org licenses by 2 0
cc-by-2.5 creativecommons: creativecommons org licenses by 2 5
cc-by-3.0 creativecommons: creativecommons org licenses by 3 0
cc-by-4.0 creativecommons: creativecommons org licenses by 4 0
cc-by-sa-2.0 creativecommons: creativecommons org licenses by sa 2 0
cc-by-sa-2.5 creativecommons: creativecommons org licenses by sa 2 5
cc-by-sa-3.0 creativecommons: creativecommons org licenses by sa 3 0
cc-by-sa-4.0 creativecommons: creativecommons org licenses by sa 4 0
cc-by-nc-3.0 creativecommons: creativecommons org licenses by nc 3 0
cc-by-nc-4.0 creativecommons: creativecommons org licenses by nc 4 0
cc-by-nd-3.0 creativecommons: creativecommons org licenses by nd 3 0
cc-by-nd-4.0 creativecommons: creativecommons org licenses by nd 4 0
cc-by-nc-sa-3.0 creativecommons: creativecommons org licenses by nc sa 3 0
cc-by-nc-sa-4.0 creativecommons: creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-3.0 creativecommons: creativecommons org licenses by nc nd 3 0
cc-by-nc-nd-4.0 creativecommons: creativecommons org licenses by nc nd 4 0
odbl-1.0 odbl: spdx license identifier odbl 1 0
odbl-1.0 opendatacommons: opendatacommons org licenses odbl( 1 0)?
odc-by-1.0 opendatacommons: opendatacommons org licenses by( 1 0)?
pddl-1.0 opendatacommons: opendatacommons org licenses pddl( 1 0)?
ogl-3.0 ogl: (licensed under the )?open government licence v3 0 ogl
ogl-3.0 nationalarchives: nationalarchives gov uk doc open government licence version 3
ofl-1.1 ofl: (licensed under the sil open font license version 1 1 ofl|spdx license identifier ofl 1 1|scripts sil org ofl)
ofl-1.1 sil: licensed under the sil open font license( version)? 1 1
proprietary unauthorized: unauthorized (copying|reproduction|use|distribution) of this (file|software|document|work) (via any medium )?is strictly prohibited
proprietary proprietary: this (software|document|file|work) is proprietary and confidential
proprietary reproduced: no part of this (publication|book|work|document) may be reproduced
proprietary nondisclosure: subject to (a |the )?nondisclosure agreement
"""

# Level 1: names with their version.
VERSIONS = r"""
apache-1.0 apache: apache (software )?license (version |v )?1 0
apache-1.1 apache: apache (software )?license (version |v )?1 1
apache-2.0 apache: apache (software )?license (version |v )?2( 0)?
apache-2.0 apache: apache 2( 0)?( licensed?)?
apache-2.0 asl: asl 2( 0)?
bsd-2-clause bsd: (bsd 2 clause|2 clause bsd|simplified bsd|freebsd bsd)( license)?
bsd-3-clause bsd: (bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)( license)?
bsd-4-clause bsd: (bsd 4 clause|4 clause bsd|original bsd|old bsd)( license)?
gpl-1.0 general: (gnu )?general public license (gpl )?(version |v )?1( 0)?
gpl-2.0 general: (gnu )?general public license (gpl )?(version |v )?2( 0)?( only| or later)?
gpl-3.0 general: (gnu )?general public license (gpl )?(version |v )?3( 0)?( only| or later)?
gpl-2.0 v2: (gnu )?general public license v2
gpl-3.0 v3: (gnu )?general public license v3
gpl-1.0 gpl: gpl (version |v )?1( 0)?( only| or later)?
gpl-2.0 gpl: gpl (version |v )?2( 0)?( only| or later)?
gpl-3.0 gpl: gpl (version |v )?3( 0)?( only| or later)?
gpl-2.0 gpl: gpl v2
gpl-3.0 gpl: gpl v3
gpl-2.0 gplv2: gplv2( only| or later)?
gpl-3.0 gplv3: gplv3( only| or later)?
lgpl-2.0 lgpl: lgpl (version |v )?2 0( only| or later)?
lgpl-2.1 lgpl: lgpl (version |v )?2 1( only| or later)?
lgpl-3.0 lgpl: lgpl (version |v )?3( 0)?( only| or later)?
lgpl-2.1 lgpl: lgpl v2 1
lgpl-3.0 lgpl: lgpl v3
lgpl-2.1 lgplv2: lgplv2( 1)?
lgpl-3.0 lgplv3: lgplv3
lgpl-2.0 library: (gnu )?library general public license (version |v )?2( 0)?
lgpl-2.1 lesser: (gnu )?lesser general public license (version |v )?2 1
lgpl-3.0 lesser: (gnu )?lesser general public license (version |v )?3( 0)?
agpl-3.0 agpl: agpl (version |v )?3( 0)?( only| or later)?
agpl-3.0 agplv3: agplv3
agpl-3.0 affero: (gnu )?affero general public license (version |v )?3( 0)?
gfdl gfdl: gfdl (version |v )?1 [1-3]
gfdl documentation: (gnu )?free documentation license (version |v )?1 [1-3]
mpl-1.0 mozilla: mozilla public license (version |v )?1 0
mpl-1.1 mozilla: mozilla public license (version |v )?1 1
mpl-2.0 mozilla: mozilla public license (version |v )?2( 0)?
mpl-1.1 mpl: mpl (version |v )?1 1
mpl-2.0 mpl: mpl (version |v )?2( 0)?
epl-1.0 eclipse: eclipse public license (version |v )?1( 0)?
epl-2.0 eclipse: eclipse public license (version |v )?2( 0)?
epl-1.0 epl: epl (version |v )?1 0
epl-2.0 epl: epl (version |v )?2 0
edl-1.0 eclipse: eclipse distribution license (version |v )?1 0
cddl-1.0 cddl: cddl (version |v )?1 0
cddl-1.1 cddl: cddl (version |v )?1 1
cpl-1.0 common: common public license (version |v )?1 0
cpal-1.0 attribution: common public attribution license( version)? 1 0
osl-3.0 osl: osl (version |v )?3 0
osl-3.0 open: open software license (version |v )?3 0
afl-3.0 academic: academic free license (version |v )?3 0
eupl-1.1 union: european union public licence (version |v )?1 1
eupl-1.2 union: european union public licence (version |v )?1 2
artistic-1.0 artistic: artistic license (version |v )?1( 0)?
artistic-2.0 artistic: artistic license (version |v )?2( 0)?
bsl-1.0 boost: boost software license( version)? 1 0
busl-1.1 business: business source license( version)? 1 1
elastic-2.0 elastic: elastic license (version |v )?2( 0)?
sspl-1.0 sspl: sspl (version |v )?1( 0)?
sspl-1.0 server: server side public license( version)? 1( 0)?
python-2.0 python: python (software foundation )?license (version |v )?2( 0)?
zpl-2.1 zope: zope public license( version)? 2 1
ofl-1.1 font: (sil )?open font license( version)? 1 1
cc0-1.0 cc0: cc0 1 0( universal)?
cc-by-1.0 cc: cc by 1 0
cc-by-2.0 cc: cc by 2 0
cc-by-2.5 cc: cc by 2 5
cc-by-3.0 cc: cc by 3 0
cc-by-4.0 cc: cc by 4 0
cc-by-sa-1.0 cc: cc by sa 1 0
cc-by-sa-2.0 cc: cc by sa 2 0
cc-by-sa-2.5 cc: cc by sa 2 5
cc-by-sa-3.0 cc: cc by sa 3 0
cc-by-sa-4.0 cc: cc by sa 4 0
cc-by-nc-2.0 cc: cc by nc 2 0
cc-by-nc-2.5 cc: cc by nc 2 5
cc-by-nc-3.0 cc: cc by nc 3 0
cc-by-nc-4.0 cc: cc by nc 4 0
cc-by-nd-2.0 cc: cc by nd 2 0
cc-by-nd-3.0 cc: cc by nd 3 0
cc-by-nd-4.0 cc: cc by nd 4 0
cc-by-nc-sa-2.0 cc: cc by nc sa 2 0
cc-by-nc-sa-2.5 cc: cc by nc sa 2 5
cc-by-nc-sa-3.0 cc: cc by nc sa 3 0
cc-by-nc-sa-4.0 cc: cc by nc sa 4 0
cc-by-nc-nd-2.0 cc: cc by nc nd 2 0
cc-by-nc-nd-3.0 cc: cc by nc nd 3 0
cc-by-nc-nd-4.0 cc: cc by nc nd 4 0
cc-by-3.0 attribution: creative commons attribution 3 0( unported| international)?( license)?
cc-by-4.0 attribution: creative commons attribution 4 0( international)?( public)?( license)?
cc-by-sa-3.0 sharealike: creative commons attribution sharealike 3 0( unported)?( license)?
cc-by-sa-4.0 sharealike: creative commons attribution sharealike 4 0( international)?( public)?( license)?
cc-by-nc-4.0 noncommercial: creative commons attribution noncommercial 4 0( international)?( public)?( license)?
cc-by-nc-sa-4.0 sharealike: creative commons attribution noncommercial sharealike 4 0( international)?( public)?( license)?
cc-by-nd-4.0 noderivatives: creative commons attribution noderivatives 4 0( international)?( public)?( license)?
cc-by-nc-nd-4.0 noderivatives: creative commons attribution noncommercial noderivatives 4 0( international)?( public)?( license)?
ogl-1.0 government: open government licence (version |v )?1 0
ogl-2.0 government: open government licence (version |v )?2 0
ogl-3.0 government: open government licence (version |v )?3 0
odbl-1.0 odbl: odbl (version |v )?1 0
cdla-permissive-2.0 cdla: cdla permissive (version |v )?2 0
cdla-sharing-1.0 cdla: cdla sharing (version |v )?1 0
"""

# Level 2: names without a version.
NAMES = r"""
apache apache: apache (software )?license
apache apache: apache licensed
mit mit: mit licensed?
mit mit: mit style license
mit x11: (mit )?x11 license
mit expat: expat license
isc isc: isc license
bsd bsd: bsd (style )?licensed?
0bsd 0bsd: 0bsd
gpl gnu: gnu general public licen[cs]e
gpl gnu: gnu (gpl|public license)
gpl gpl: gpl licensed
gpl copyleft: gnu copyleft
lgpl lesser: (gnu )?lesser general public licen[cs]e
lgpl library: (gnu )?library general public licen[cs]e
lgpl lgpl: (gnu )?lgpl
agpl affero: (gnu )?affero general public licen[cs]e
agpl agpl: (gnu )?agpl
gfdl gfdl: (gnu )?gfdl
gfdl documentation: (gnu )?free documentation licen[cs]e
mpl mozilla: mozilla public licen[cs]e
epl eclipse: eclipse public licen[cs]e
cddl development: common development and distribution license
cpl common: common public license
ipl ibm: ibm public license
osl open: open software license
afl academic: academic free license
eupl eupl: eupl
eupl union: european union public licen[cs]e
artistic artistic: (perl )?artistic license
boost boost: boost software license
busl business: business source license
sspl server: server side public license
elastic elastic: elastic license
psf python: python software foundation license
ruby ruby: ruby license
php php: php license
zope zope: zope public license
zlib zlib: zlib( libpng)? license
libpng libpng: libpng license
openssl openssl: openssl license
curl curl: curl license
ncsa ncsa: (university of illinois )?ncsa (open source )?license
w3c w3c: w3c (software )?(notice|license)( and license)?
unicode unicode: unicode (terms of use|license agreement)
ofl font: (sil )?open font license
unlicense unlicense: (the )?unlicense
wtfpl wtfpl: wtfpl
beerware beerware: beerware( license)?
cc0 cc0: cc0
cc0 zero: creative commons zero
cc-by-sa cc: cc by sa
cc-by-nc cc: cc by nc
cc-by-nd cc: cc by nd
cc-by-nc-sa cc: cc by nc sa
cc-by-nc-nd cc: cc by nc nd
cc-by attribution: creative commons attribution
cc-by-sa sharealike: creative commons attribution sharealike
cc-by-nc noncommercial: creative commons attribution noncommercial
cc-by-nd noderivatives: creative commons attribution noderivatives
creative-commons commons: creative commons( licen[cs]ed?)?
odbl odbl: odbl
odbl database: open database license
odc-by odc: odc by
ogl government: open government licen[cs]e
cdla data: community data license agreement
"""

# Level 3: hints that a text states its terms, without naming a license.
HINTS = r"""
public-domain domain: (in|into|to) the public domain
public-domain domain: public domain dedication
copyright copyright: copyright (c |© )?(19|20)\d\d
copyright copyright: c copyright
copyright rights: (some|no) rights reserved
licensed licensed: licensed under
licensed license: (subject to|under|terms of) the license
licensed licence: (subject to|under|terms of) the licence
licensed terms: (terms and conditions|terms of (use|service)) apply
licensed permission: used (with|by) permission
licensed permission: permission is (hereby )?granted
restricted reproduction: reproduction (is )?prohibited
restricted permission: without (the )?(prior |express |written )*permission
restricted commercial: (not for|non|no) commercial use
restricted confidential: (strictly |company )?confidential
restricted internal: for internal use only
warranty warranty: without warranty of any kind
warranty warranties: without warranties or conditions of any kind
warranty as: provided as is
trademark trademark: (is a |are )?(registered )?trademark of
trademark trademarks: (are )?(registered )?trademarks of
"""

# The phrases that are always reported, and their labels.
BASE = [("cc-by", "cc", "cc by"), ("gpl", "general", "general public license"), ("reserved", "reserved", "all rights reserved")]


def signatures() -> list[tuple[int, str, str, str]]:
    """level, label, keyword and pattern of every signature, in order."""
    out = []
    for level, group in enumerate((NOTICES, VERSIONS, NAMES, HINTS)):
        for line in group.strip().splitlines():
            head, pattern = line.split(": ", 1)
            out.append((level, *head.split(" "), pattern))
    return out
