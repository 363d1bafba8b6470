"""Licence notices that the scanner learns from, and sentences that only resemble them.

Fixed values: the usual wording of public licence notices. Each is a template that predictions are compared with.
"""

from __future__ import annotations

#: Family, name of the template, wording.
TEMPLATES: tuple[tuple[str, str, str], ...] = (
    ("mit", "mit-short", "Released under the MIT License."),
    ("mit", "mit-licensed", "This project is licensed under the MIT License, see the LICENSE file for details."),
    ("mit", "mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."),
    ("mit", "mit-warranty", "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement."),
    ("apache", "apache-short", "Licensed under the Apache License, Version 2.0."),
    ("apache", "apache-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "apache-basis", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "gpl-short", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "gpl-free", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "gpl-hope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; see the GNU General Public License for more details."),
    ("lgpl", "lgpl-short", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl", "lgpl-free", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation."),
    ("agpl", "agpl-short", "Licensed under the GNU Affero General Public License, version 3."),
    ("bsd", "bsd-short", "Distributed under the BSD 3-Clause License."),
    ("bsd", "bsd-redistribution", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd", "bsd-names", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("mpl", "mpl-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, you can obtain one at http://mozilla.org/MPL/2.0/."),
    ("isc", "isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("cc-by", "cc-by-short", "Licensed under CC BY 4.0."),
    ("cc-by", "cc-by-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "cc-by-sa-short", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "cc-by-sa-notice", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "cc-by-nc-short", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "cc-by-nc-notice", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0", "cc0-notice", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal, and dedicates it to the public domain."),
    ("unlicense", "unlicense-notice", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, for any purpose, commercial or non-commercial."),
    ("proprietary", "rights-short", "All rights reserved."),
    ("proprietary", "rights-copyright", "Copyright (c) 2020 Example Company. All rights reserved."),
    ("proprietary", "rights-forbidden", "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher."),
)

#: Sentences with words of licences that state none.
UNRELATED: tuple[str, ...] = (
    "He lost his driver license in the park and had to apply for a new one at the office.",
    "The fishing license costs twenty dollars a year and is sold at the harbour.",
    "All rights of the citizens were debated in parliament that summer.",
    "The general public was free to visit the museum on Sundays.",
    "The software was useful, but the documentation was written in a hurry.",
    "Copyright law has changed many times over the last two centuries.",
    "She had no permission to leave the building without a written notice.",
    "The version of the story published in the paper was shorter than the original.",
    "The author reserved a table for four under his own name.",
    "They were granted a copy of the map free of charge at the station.",
    "The foundation of the house was built on an old stone wall.",
    "You may not use the lift in case of fire.",
    "Creative work takes time, and the commons were open to everyone in the village.",
    "The terms of the agreement were read aloud, and both parties signed it.",
    "Conditions on the road were poor and the source of the noise was never found.",
    "It is in the hope of better weather that we set out again the next morning.",
    "The product was sold without warranty, and nobody bought it.",
    "A person obtaining a ticket at the counter must show it at the door.",
    "The Apache were a people of the American southwest.",
    "The university was founded in Massachusetts, and its library is open to the public.",
    "The holder of the ticket is required by law to keep it until the end of the journey.",
    "An international attribution of the painting to the master is still in doubt.",
    "The binary star was observed in two forms of light.",
    "The list of names was distributed to the following members of the club.",
    "To the extent possible the work was done by hand.",
    "The domain of the function is the set of all real numbers.",
)
