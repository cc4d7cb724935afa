"""Whole documents as strings, for small results in tests."""

from __future__ import annotations

from ledgerlight.operators import report_json, report_md, report_xml


def array(fragments) -> str:
    return "".join(r.fragment for r in fragments.orderBy("doc_part", "item_no").collect())


def document(fragments) -> str:
    return "".join(r.fragment for r in report_json.ordered_fragments(fragments).collect())


def markdown(lines) -> str:
    return "".join(r.line + "\n" for r in report_md.ordered_lines(lines).collect())


def xml(lines) -> str:
    return "\n".join(r.line for r in report_xml.ordered_lines(lines).collect()) + "\n"
