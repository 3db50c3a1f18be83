"""Wordings of public licenses by which texts declare or carry them, as (license, wording).

For each family the headers of its versions and the passage of the body that no other version has, so that the wording
held best tells them apart.
"""

_FSF = "you can redistribute it and/or modify it under the terms of the {0} as published by the Free Software Foundation{1} either version {2} of the License, or (at your option) any later version."
_BSD = (
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following"
    " disclaimer in the documentation and/or other materials provided with the distribution. "
)

TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files, to deal in the Software without restriction, including without limitation the rights to"
            " use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
                   " http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual,"
                   " worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare"
                   " Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such"
                   " Derivative Works in Source or Object form."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: " + _FSF.format("GNU General Public License", ",", "3")),
    ("GPL-3.0", "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; " + _FSF.format("GNU General Public License", ";", "2")),
    ("GPL-2.0", "This General Public License applies to most of the Free Software Foundation's software and to any other"
                " program whose authors commit to using it."),
    ("AGPL-3.0", "This program is free software: " + _FSF.format("GNU Affero General Public License", ",", "3")),
    ("AGPL-3.0", "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works,"
                 " specifically designed to ensure cooperation with the community in the case of network server software."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This program is free software: " + _FSF.format("GNU Lesser General Public License", ",", "3")),
    ("LGPL-3.0", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of"
                 " the GNU General Public License, supplemented by the additional permissions listed below."),
    ("LGPL-2.1", "This library is free software; " + _FSF.format("GNU Lesser General Public License", ";", "2.1")),
    ("LGPL-2.1", "This license, the Lesser General Public License, applies to some specially designated software"
                 " packages--typically libraries--of the Free Software Foundation and other authors who decide to use it."),
    ("LGPL-2.0", "This library is free software; " + _FSF.format("GNU Library General Public License", ";", "2")),
    ("LGPL-2.0", "This license, the Library General Public License, applies to some specially designated Free Software"
                 " Foundation software, and to any other libraries whose authors decide to use it."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of"
                " his or her rights to the work worldwide under copyright law"),
    ("CC0-1.0", "Certain owners wish to permanently relinquish those rights to a Work for the purpose of contributing to a"
                " commons of creative, cultural and scientific works"),
    ("BSD-3-Clause", _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse"
                     " or promote products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", _BSD + 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED'
                     " WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
            " granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
                  " publish, use, compile, sell, or distribute this software, either in source code form or as a compiled"
                  " binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to"
             " alter it and redistribute it freely, subject to the following restrictions"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and"
                " accompanying documentation covered by this license"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
)
