"""Model answers as SQL text over a document, for queries that check validation.

All three are plain SQL expressions: ``WHOLE_ANSWER`` over ``text``, and the two
attempts over ``size`` (the text's length) and ``whole``. Spark and any other engine
build the same strings from them. What goes wrong with an answer, and which labels it
gives, follows from the text's length.
"""

from __future__ import annotations

from labelloom.taxonomy import FIELD_NAMES, LIST_DOMAINS, SCALAR_DOMAINS


def _nth(values: tuple[str, ...], stride: int) -> str:
    """One of ``values``, picked by the text's size."""
    place = f"CAST((length(text) + {stride}) % {len(values)} + 1 AS INT)"
    return f"split_part('{','.join(values)}', ',', {place})"


def _member(name: str, stride: int) -> str:
    """SQL of a member ``"name":value``."""
    if name == "one_sentence_description":
        return f"""'"{name}":"Text of ', length(text), ' characters."'"""
    if name == "country_relevance":
        listed = """CASE WHEN length(text) % 2 = 0 THEN '["Denmark","none"]' ELSE '[]' END"""
        return f"""'"{name}":', {listed}"""
    if name in LIST_DOMAINS:
        first, second = _nth(LIST_DOMAINS[name], stride), _nth(LIST_DOMAINS[name], stride + 3)
        pair = f"""concat('["', {first}, '","', {second}, '"]')"""
        return f"""'"{name}":', CASE WHEN length(text) % 3 = 0 THEN '[]' ELSE {pair} END"""
    return f"""'"{name}":"', {_nth(SCALAR_DOMAINS[name], stride)}, '"'"""


_MEMBERS = ", ',', ".join(_member(name, stride) for stride, name in enumerate(FIELD_NAMES))
WHOLE_ANSWER = f"concat('{{', {_MEMBERS}, '}}')"

FIRST_ANSWER = """CASE
  WHEN size % 7 = 0 THEN substring(whole, 1, 300)
  WHEN size % 11 = 0 THEN ''
  WHEN size % 13 = 0 THEN replace(whole, '"content_quality":"', '"content_quality":"very ')
  WHEN size % 17 = 0 THEN concat(whole, ' as requested')
  WHEN size % 19 = 0 THEN replace(whole, '"regional_relevance":', '"regional":')
  WHEN size % 23 = 0 THEN replace(whole, '{', '{"note":"x",')
  WHEN size % 29 = 0 THEN replace(whole, '"Text of ', '42,"more":"')
  WHEN size % 31 = 0 THEN replace(whole, '"content_type":', '"content_type":["poetry"],"more":')
  WHEN size % 37 = 0 THEN replace(whole, 'Text of', repeat('é', 201))
  WHEN size % 41 = 0 THEN replace(whole, '"business_sector":[', '"business_sector":"other","x":[')
  WHEN size % 43 = 0 THEN concat('[', whole, ']')
  WHEN size % 5 = 0 THEN replace(whole, '"time_sensitivity"', '"time_sensitive"')
  ELSE whole END"""

SECOND_ANSWER = """CASE
  WHEN size % 13 = 0 THEN replace(whole, '"content_quality":"', '"content_quality":"very ')
  WHEN size % 77 = 0 THEN ''
  ELSE whole END"""
