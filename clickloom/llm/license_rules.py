"""The signature rules of licenses and notices, in order: label; kind; words of which all of one alternative must occur; pattern.

Patterns see a text as lower-case words parted by one space, dots and dashes being gone: ``GPL-3.0`` reads ``gpl 3 0``. They begin
and end at word borders. Kinds, by falling priority: t a passage of the license text, v a name with version, n a name,
h a hint. ``<L>`` stands for license in either spelling, ``<3>`` or ``<2 1>`` for a version with or without the word."""

RULES = r"""
gpl-1.0-only; v; gpl; (?:gnu )?gpl <1> only
gpl-2.0-only; v; gpl; (?:gnu )?gpl <2> only
gpl-2.0-or-later; v; gpl; (?:gnu )?gpl <2>(?: or (?:any )?later| or greater| or newer)
gpl-3.0-only; v; gpl; (?:gnu )?gpl <3> only
gpl-3.0-or-later; v; gpl; (?:gnu )?gpl <3>(?: or (?:any )?later| or greater| or newer)
gpl-1.0; v; gpl|gplv1; (?:gnu )?gpl(?: <L>)? <1>|gplv1
gpl-2.0; v; gpl|gplv2|gpl2; (?:gnu )?gpl(?: <L>)? <2>|gplv2(?: 0)?|gpl2
gpl-3.0; v; gpl|gplv3|gpl3; (?:gnu )?gpl(?: <L>)? <3>|gplv3(?: 0)?|gpl3
gpl-2.0-or-later; v; gplv2; gplv2(?: 0)? or (?:any )?later
gpl-3.0-or-later; v; gplv3; gplv3(?: 0)? or (?:any )?later
gpl-1.0; v; gnu+general+public; gnu general public <L> <1>
gpl-2.0; v; gnu+general+public; gnu general public <L> <2>
gpl-3.0; v; gnu+general+public; gnu general public <L> <3>
gpl-2.0-or-later; v; gnu+general+later; gnu general public <L>(?: \S+){0,12} version 2(?: 0)?(?: of the <L>)? or (?:at your option )?any later version
gpl-3.0-or-later; v; gnu+general+later; gnu general public <L>(?: \S+){0,12} version 3(?: 0)?(?: of the <L>)? or (?:at your option )?any later version
gpl-2.0-or-later; v; free+foundation+later; free software foundation either version 2(?: 0)? of the <L> or at your option any later version
gpl-3.0-or-later; v; free+foundation+later; free software foundation either version 3(?: 0)? of the <L> or at your option any later version
gpl; t; redistribute+gnu+general; redistribute it and or modify it under the terms of the gnu general public <L>
gpl; t; copyleft+general; the gnu general public <L> is a free copyleft <L> for software
gpl; t; details+gnu+general; see the gnu general public <L> for more details
gpl; t; copy+gnu+general; you should have received a copy of the gnu general public <L>
gpl-3.0; t; propagate+permission; to propagate a work means to do anything with it that without permission
gpl-3.0; t; conveying+circumstances; conveying under any other circumstances is permitted solely under the conditions
gpl-2.0; t; sublicense+program; you may not copy modify sublicense or distribute the program except as expressly provided under this <L>
gpl; n; gnu+gpl; gnu gpl
gpl; h; gpl; licensed under (?:the )?gpl
gpl-with-classpath-exception; v; gpl+classpath; gpl(?: \S+){0,4} with (?:the )?classpath exception
gpl-with-gcc-exception; v; gcc+exception; gcc runtime library exception
gpl-with-font-exception; v; gpl+font; gpl(?: \S+){0,4} with (?:the )?font exception
gpl-with-autoconf-exception; v; autoconf+exception; with (?:the )?autoconf exception
gpl-with-bison-exception; v; bison+exception; bison exception
linking-exception; t; special+exception; as a special exception(?: \S+){0,20} link(?:ing)?
lgpl-2.0; v; library+general; gnu library general public <L>(?: <2>)?
lgpl-2.1; v; lesser+general; (?:gnu )?lesser general public <L> <2 1>
lgpl-3.0; v; lesser+general; (?:gnu )?lesser general public <L> <3>
lgpl; n; lesser+general; (?:gnu )?lesser general public <L>
lgpl-2.0; v; lgpl; (?:gnu )?lgpl <2> only
lgpl-2.1; v; lgpl|lgplv2; (?:gnu )?lgpl <2 1>|lgplv2 1
lgpl-3.0; v; lgpl|lgplv3; (?:gnu )?lgpl <3>|lgplv3
lgpl; n; lgpl; (?:gnu )?lgpl
lgpl; t; gnu+lesser; under the terms of the gnu lesser general public <L>
lgpl; t; library+work+uses; work that uses the library
agpl-3.0; v; affero; (?:gnu )?affero general public <L> <3>
agpl-1.0; v; affero; affero general public <L> <1>
agpl; n; affero; (?:gnu )?affero general public <L>
agpl-3.0; v; agpl|agplv3|agpl3; (?:gnu )?agpl <3>|agplv3|agpl3
agpl; n; agpl; (?:gnu )?agpl
agpl; t; remotely+network; interact(?:ing)? with it remotely through a computer network
gfdl-1.1; v; gnu+documentation; gnu free documentation <L> <1 1>
gfdl-1.2; v; gnu+documentation; gnu free documentation <L> <1 2>
gfdl-1.3; v; gnu+documentation; gnu free documentation <L> <1 3>
gfdl; n; documentation+free; (?:gnu )?free documentation <L>
gfdl; n; gfdl; (?:gnu )?gfdl
gfdl; t; invariant+sections; with no invariant sections(?: no| with no)? front cover texts
apache-1.0; v; apache; apache (?:software )?<L> <1 0>
apache-1.1; v; apache; apache (?:software )?<L> <1 1>
apache-2.0; v; apache; apache (?:software )?<L> <2>
apache-2.0; v; apache; apache <2>(?: <L>)?
apache-2.0; v; asl; asl <2>
apache; n; apache+software; apache software <L>
apache-2.0; t; licenses+org+apache; (?:http |https )?(?:www )?apache org licenses <L> 2 0
apache-2.0; t; compliance+file+except; you may not use this file except in compliance with the <L>
apache-2.0; t; law+writing+distributed; unless required by applicable law or agreed to in writing software distributed under the <L>
apache-2.0; t; contributor+grants+perpetual; each contributor hereby grants to you a perpetual worldwide non exclusive
apache; t; apache+includes; this product includes software developed by the apache (?:software foundation|group)
mit; v; expat; (?:mit expat|expat)(?: mit)? <L>
mit-0; v; mit+0|mit+attribution; mit 0|mit no attribution
mit-x11; v; x11; (?:mit )?x11(?: mit)? <L>
mit-modern; v; mit+modern; modern mit <L>|mit <L> modern variant
mit-cmu; v; cmu+mit; mit cmu|cmu mit
mit; n; mit+licensed; mit licensed|licensed under (?:the )?mit
mit; t; permission+charge+obtaining; permission is hereby granted free of charge to any person obtaining a copy
mit; t; permission+copies+substantial; this permission notice shall be included in all copies or substantial portions of the software
mit; t; warranty+software+implied; the software is provided as is without warranty of any kind express or implied
mit; h; opensource+mit; opensource org licenses mit
mit-advertising; t; substantial+documentation; (?:notice|advertising)(?: \S+){0,10} included in all copies or substantial portions of the software and its documentation
isc; n; isc; isc <L>|licensed under (?:the )?isc
isc; t; permission+modify+fee; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
hpnd; t; permission+fee+documentation; permission to use copy modify and distribute this software and its documentation for any purpose(?: and)? without fee
0bsd; v; 0bsd; 0bsd
0bsd; v; bsd+clause; (?:bsd zero clause|zero clause bsd|bsd 0 clause)(?: <L>)?
bsd-1-clause; v; bsd+1|bsd+one; (?:bsd (?:1|one) clause|(?:1|one) clause bsd)(?: <L>)?
bsd-2-clause; v; bsd+2|bsd+two; (?:bsd (?:2|two) clause|(?:2|two) clause bsd)(?: <L>)?
bsd-3-clause; v; bsd+3|bsd+three; (?:bsd (?:3|three) clause|(?:3|three) clause bsd)(?: <L>)?
bsd-4-clause; v; bsd+4|bsd+four; (?:bsd (?:4|four) clause|(?:4|four) clause bsd)(?: <L>)?
bsd-2-clause; v; bsd+simplified; simplified bsd(?: <L>)?
bsd-2-clause; v; freebsd; freebsd <L>
bsd-3-clause; v; bsd+new|bsd+revised|bsd+modified; (?:new|revised|modified) bsd(?: <L>)?
bsd-4-clause; v; bsd+original; original bsd(?: <L>)?
bsd-patent; v; bsd+patent; bsd (?:2 clause )?(?:plus )?patent(?: <L>)?
bsd-3-clause-clear; v; bsd+clear; (?:clear bsd|bsd 3 clause clear)(?: <L>)?
bsd; n; bsd; bsd(?: style)? <L>|licensed under (?:the )?bsd
bsd; t; redistributions+source; redistributions of source code must retain the above copyright notice
bsd; t; redistributions+binary; redistributions in binary form must reproduce the above copyright notice
bsd-3-clause; t; endorse+promote; (?:neither the name(?: \S+){0,16}|may not be used to|may be used to) endorse or promote products derived
bsd-4-clause; t; advertising+mentioning; all advertising materials mentioning features or use of this software must display
bsd; t; exemplary+consequential; in no event shall(?: \S+){1,8} be liable for any direct indirect incidental special exemplary or consequential damages
mpl-1.0; v; mozilla; mozilla public <L> <1 0>
mpl-1.1; v; mozilla; mozilla public <L> <1 1>
mpl-2.0; v; mozilla; mozilla public <L> <2>
mpl; n; mozilla; mozilla public <L>
mpl-1.1; v; mpl; mpl <1 1>
mpl-2.0; v; mpl; mpl <2>
mpl-2.0; t; mozilla+subject; this source code form is subject to the terms of the mozilla public <L>
mpl-1.1; t; contents+subject+mozilla; the contents of this file are subject to the mozilla public <L>
npl-1.1; v; netscape; netscape public <L>(?: <1 1>)?
epl-1.0; v; eclipse; eclipse public <L> <1>
epl-2.0; v; eclipse; eclipse public <L> <2>
epl; n; eclipse; eclipse public <L>
epl; v; epl; epl <1>|epl <2>
edl-1.0; v; eclipse+distribution; eclipse distribution <L>(?: <1>)?
cpl-1.0; v; common+public; common public <L>(?: <1>)?
cddl-1.0; v; cddl; cddl(?: <1 0>)?
cddl-1.1; v; cddl; cddl <1 1>
cddl; n; common+development; common development and distribution <L>
eupl-1.1; v; eupl; eupl <1 1>
eupl-1.2; v; eupl; eupl <1 2>
eupl; n; european+union; european union public <L>
osl-3.0; v; open+software; open software <L> <3>
osl; n; open+software; open software <L>
afl-3.0; v; academic+free; academic free <L>(?: <3>)?
artistic-1.0; v; artistic; artistic <L> <1>
artistic-2.0; v; artistic; artistic <L> <2>
artistic; n; artistic; (?:the |perl )?artistic <L>
perl; n; perl+terms; under the same terms as perl(?: itself)?
python-2.0; v; python|psf; (?:psf|python software foundation)(?: <L>)?(?: <2>)?
python; n; python; python (?:software foundation )?<L>
ruby; n; ruby; ruby <L>
php-3.01; v; php; php <L> <3 01>
php; n; php; php <L>
zlib; n; zlib; zlib(?: libpng)? <L>
zlib; t; misrepresented+origin; the origin of this software must not be misrepresented
libpng; n; libpng|png; libpng <L>|png reference library <L>
bsl-1.0; v; boost; boost software <L>(?: <1>)?
bsl-1.0; t; organization+accompanying; permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
unlicense; n; unlicense; (?:the )?unlicense
unlicense; t; unencumbered; this is free and unencumbered software released into the public domain
wtfpl; n; wtfpl|fuck; wtfpl|do what the fuck you want to public <L>
beerware; n; beerware|beer; beerware(?: <L>)?|beer ware <L>
postgresql; n; postgresql; postgresql <L>
openssl; n; openssl; openssl <L>
openssl; t; openssl+developed; this product includes software developed by the openssl project
curl; n; curl; curl <L>
ms-pl; n; microsoft+public; microsoft public <L>
ms-rl; n; microsoft+reciprocal; microsoft reciprocal <L>
ms-eula; n; microsoft+terms; microsoft software <L> terms
apsl-2.0; v; apple; apple public source <L>(?: <2>)?
ibm-public; v; ibm; ibm public <L>(?: <1>)?
sun-public; n; sun; sun public <L>
oracle-bcl; n; oracle; oracle binary code <L>
oracle-upl; n; universal+permissive; universal permissive <L>
nasa-1.3; v; nasa; nasa open source agreement(?: <1 3>)?
ncsa; n; ncsa|illinois; (?:university of illinois )?ncsa open source <L>|illinois open source <L>
w3c; n; w3c; w3c (?:software )?(?:notice and )?<L>
ofl-1.1; v; sil|ofl; sil open font <L>(?: <1 1>)?|ofl <1 1>
ofl; t; bundled+redistributed; may be bundled redistributed and or sold with any software provided that(?: \S+){0,12} copyright notice
lppl-1.3; v; latex; latex project public <L>(?: <1 3>)?
lppl; n; lppl; lppl
qpl-1.0; v; qpl|q; q public <L>|qpl(?: <1 0>)?
tcl; n; tcl; tcl(?: tk)? <L>
vim; n; vim; vim <L>
sleepycat; n; sleepycat; sleepycat <L>
cecill-2.1; v; cecill; cecill(?: <L>)? <2 1>
cecill; n; cecill; cecill(?: b| c)?(?: <L>)?
icu; n; icu; icu <L>
unicode; n; unicode; unicode(?: inc)? <L> agreement|unicode <L>
blueoak-1.0; v; oak; blue oak model <L>(?: <1>)?
upl-1.0; v; upl; upl <1>
ecl-2.0; v; educational; educational community <L>(?: <2>)?
efl-2.0; v; eiffel; eiffel forum <L>(?: <2>)?
mulan-2.0; v; mulan; mulan (?:permissive|psl)(?: software <L>)?(?: <2>)?
sspl-1.0; v; sspl; sspl(?: <1>)?
sspl-1.0; n; server+side; server side public <L>
busl-1.1; v; busl|business; business source <L>(?: <1 1>)?|busl(?: <1 1>)?
elastic-2.0; v; elastic; elastic <L>(?: <2>)?
commons-clause; n; commons+clause; commons clause
polyform; n; polyform; polyform (?:noncommercial|small business|shield|strict|perimeter)(?: <L>)?
confluent; n; confluent; confluent community <L>
redis-source; n; redis; redis source available <L>
openrail; n; openrail|rail; (?:big ?science |creativeml )?open ?rail(?: m)?(?: <L>)?
llama-community; n; llama; llama(?: 2| 3)? community <L>
cc0-1.0; v; cc0; cc0(?: <1 0>)?
cc0-1.0; n; cc+zero|creative+zero; cc zero|creative commons zero
cc-by-1.0; v; cc+by; cc by <1 0>
cc-by-2.0; v; cc+by; cc by <2 0>
cc-by-2.5; v; cc+by; cc by <2 5>
cc-by-3.0; v; cc+by; cc by <3 0>
cc-by-4.0; v; cc+by; cc by <4 0>
cc-by-sa-2.0; v; cc+by+sa; cc by sa <2 0>
cc-by-sa-2.5; v; cc+by+sa; cc by sa <2 5>
cc-by-sa-3.0; v; cc+by+sa; cc by sa <3 0>
cc-by-sa-4.0; v; cc+by+sa; cc by sa <4 0>
cc-by-sa; n; cc+by+sa; cc by sa
cc-by-nd-3.0; v; cc+by+nd; cc by nd <3 0>
cc-by-nd-4.0; v; cc+by+nd; cc by nd <4 0>
cc-by-nd; n; cc+by+nd; cc by nd
cc-by-nc-2.0; v; cc+by+nc; cc by nc <2 0>
cc-by-nc-3.0; v; cc+by+nc; cc by nc <3 0>
cc-by-nc-4.0; v; cc+by+nc; cc by nc <4 0>
cc-by-nc; n; cc+by+nc; cc by nc
cc-by-nc-sa-3.0; v; cc+by+nc+sa; cc by nc sa <3 0>
cc-by-nc-sa-4.0; v; cc+by+nc+sa; cc by nc sa <4 0>
cc-by-nc-sa; n; cc+by+nc+sa; cc by nc sa
cc-by-nc-nd-3.0; v; cc+by+nc+nd; cc by nc nd <3 0>
cc-by-nc-nd-4.0; v; cc+by+nc+nd; cc by nc nd <4 0>
cc-by-nc-nd; n; cc+by+nc+nd; cc by nc nd
cc-by; n; creative+attribution; creative commons attribution(?: <L>)?
cc-by-4.0; v; creative+attribution; creative commons attribution(?: <L>)? 4 0(?: international)?
cc-by-3.0; v; creative+attribution; creative commons attribution(?: <L>)? 3 0(?: unported)?
cc-by-sa; n; creative+sharealike|creative+alike; creative commons attribution share ?alike(?: <L>)?
cc-by-nc; n; creative+noncommercial|creative+commercial; creative commons attribution non ?commercial(?: <L>)?
cc-by-nd; n; creative+attribution; creative commons attribution no ?deriv(?:ative)?s?(?: <L>)?
cc-by-nc-sa; n; creative+attribution; creative commons attribution non ?commercial share ?alike(?: <L>)?
cc-by-nc-nd; n; creative+attribution; creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: <L>)?
cc-by; t; creativecommons+by; creativecommons org licenses by (?:1 0|2 0|2 5|3 0|4 0)
cc-by-sa; t; creativecommons+sa; creativecommons org licenses by sa (?:1 0|2 0|2 5|3 0|4 0)
cc-by-nc; t; creativecommons+nc; creativecommons org licenses by nc (?:1 0|2 0|2 5|3 0|4 0)
cc-by-nc-sa; t; creativecommons+nc+sa; creativecommons org licenses by nc sa (?:1 0|2 0|2 5|3 0|4 0)
cc-by-nc-nd; t; creativecommons+nc+nd; creativecommons org licenses by nc nd (?:1 0|2 0|2 5|3 0|4 0)
cc0-1.0; t; creativecommons+zero; creativecommons org publicdomain zero 1 0
cc; n; creative+commons; creative commons(?: <L>)?
odbl-1.0; v; odbl; odbl(?: <1 0>)?
odbl-1.0; n; open+database; open database <L>
odc-by-1.0; n; open+data+commons; open data commons(?: attribution <L>)?
pddl-1.0; v; pddl; pddl(?: <1 0>)?
ogl-3.0; v; government+licence; open government licence(?: v3 0| <3>)?
ogl-uk; n; crown; crown copyright
dl-de-by-2.0; v; datenlizenz; datenlizenz deutschland (?:namensnennung )?(?:version )?2 0
etalab-2.0; v; etalab; (?:licence ouverte|open licence) etalab(?: <2>)?|etalab <2>
cdla-permissive; n; cdla; cdla permissive(?: <1 0>| <2 0>)?
cdla-sharing; n; cdla; cdla sharing(?: <1 0>)?
spdx-tag; v; spdx; spdx <L> identifier \S+
public-domain; n; public+domain; (?:released into|dedicated to|placed in|in) the public domain
public-domain; t; waived+copyright; (?:has|have) waived all copyright and related or neighboring rights
all-rights-reserved; n; rights+reserved; all rights reserved
all-rights-reserved; n; droits; tous droits réservés
all-rights-reserved; n; rechte; alle rechte vorbehalten
all-rights-reserved; n; derechos; todos los derechos reservados
proprietary; n; proprietary; proprietary and confidential|confidential and proprietary|proprietary <L>
proprietary; t; reproduced+written; no part of this(?: \S+){1,6} may be reproduced(?: \S+){0,20} without(?: the)?(?: prior)? written permission
commercial; n; commercial; commercial <L>(?: agreement)?
non-commercial; h; only+use; for (?:non ?commercial|personal) use only
educational-use; h; educational; for educational (?:use|purposes) only
eula; n; eula|agreement; end user <L> agreement|eula
terms-of-use; h; terms; subject to (?:the|these|our) terms (?:of use|of service|and conditions)
shareware; n; shareware; shareware
freeware; n; freeware; freeware
trial; h; trial|evaluation; trial version|evaluation copy
copyright-notice; h; copyright; copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)*
patent-grant; t; patent+royalty; royalty free(?: \S+){0,6} patent <L>
license-reference; h; license|licence; see the <L>(?: file)? for (?:details|more information|<L> information)
license-reference; h; license|licence|licensed; licensed under the terms of
""".strip()
