"""Every operand of a broken expression is a label, and the strictest notice of a text sets its score."""

from __future__ import annotations

import pytest

from tessera.llm import licenses as li

FINDER = li.automaton(li.BASE, li.NOTICES)
TAG = "SPDX-License-Identifier: "


@pytest.mark.parametrize("broken, labels", [
    ("(MIT OR Apache-2.0", ["mit", "apache-2.0"]), ("MIT AND (Apache-2.0 OR", ["mit", "apache-2.0"]), ("((MIT) AND BSD-3-Clause see file", ["mit", "bsd-3-clause"]),
    ("(GPL-2.0 WITH Classpath-exception-2.0 OR MIT", ["gpl-2.0", "mit"]), ("OR MIT", []), ("", []),
])
def test_operands_of_broken_expressions(broken, labels):
    assert li.to_postfix(broken) is None and li.identifiers(broken) == labels
    assert li.scan(TAG + broken, FINDER)[5] == ",".join(sorted(labels))


@pytest.mark.parametrize("text, score", [
    (f"{TAG}MIT\nAll rights reserved", 1.0), (f"All rights reserved\n{TAG}MIT", 1.0), (f"{TAG}MIT All rights reserved", 1.0), (f"{TAG}CC0-1.0\nMIT License", 0.1),
    (f"{TAG}MIT\n{TAG}(GPL-2.0 OR", 0.7), (f"{TAG}MIT\n{TAG}GPL-3.0", 0.7), (f"{TAG}MIT OR GPL-3.0", 0.1),
    # phrases inside an expression are its operands: the reader may choose the other
    (f"{TAG}CC-BY-NC-4.0 OR MIT", 0.1), (f"{TAG}CC-BY-NC-4.0 OR MIT\nCC BY NC", 0.8), ("none", 0.0),
])
def test_score_of_the_strictest_notice(text, score):
    assert li.scan(text, FINDER)[6] == pytest.approx(score)
