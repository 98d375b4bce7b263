"""Elements, attributes and texts of stored HTML as native SQL expressions.

A page is cut into the tags of its list structure and what lies between, and a
card into its tags and texts, each by one regular expression that knows quoted
attribute values, comments and scripts: a ``>`` or ``<li>`` inside one of them
ends nothing.  Elements are followed with depth counters over those tokens
(``aggregate``), which is how nested and unclosed ones are told apart.

The functions take and give SQL text, to be used with ``expr``: a lambda built
call by call through the gateway would cost more than running it.  Quantified
groups are possessive, which the regex engine runs as a loop, so that a long page
does not exhaust the stack.
"""

from __future__ import annotations

# \x22 and \x27 are the two quotes
_VALUE = r"(?:\x22[^\x22]*+\x22|\x27[^\x27]*+\x27|[^\s\x22\x27>]++)"
_INSIDE = r"[^>\x22\x27]*+(?:(?:\x22[^\x22]*+\x22|\x27[^\x27]*+\x27)[^>\x22\x27]*+)*+>"
_SKIPPED = r"<!--.*?(?:-->|\z)|(?i:<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z))|<[!?][^>]*+>"
_TOKEN = rf"(?s){_SKIPPED}|</?[a-zA-Z]{_INSIDE}|[^<]++|<"
_NAME = r"^<(/?[a-zA-Z][^\s/>]*)"

# Elements without content, and the characters that named references stand for.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®",
    "trade": "™", "middot": "·", "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘",
    "rsquo": "’", "ldquo": "“", "rdquo": "”", "times": "×", "deg": "°", "euro": "€",
    "pound": "£", "yen": "¥", "cent": "¢",
}


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def tokens(html: str) -> str:
    """array<string>: tags, comments and texts in order."""
    return f"regexp_extract_all({html}, r'{_TOKEN}', 0)"


def tag_name(token: str) -> str:
    """Lower-case name of a tag ("li", "/li"), "" for a text, a comment or a declaration."""
    return f"lower(regexp_extract({token}, r'{_NAME}', 1))"


def is_text(token: str) -> str:
    return f"({token} = '<' OR NOT startswith({token}, '<'))"


def decoded(text: str) -> str:
    """Character references replaced: numeric ones and the named ones of ``ENTITIES``; others stay."""
    named = ", ".join(f"""'{k}', '{"''" if v == "'" else v}'""" for k, v in ENTITIES.items())
    code = (r"coalesce(CAST(conv(nullif(regexp_extract(_p, r'^&#[xX]([0-9a-fA-F]+);$', 1), ''), 16, 10) AS BIGINT), "
            r"CAST(nullif(regexp_extract(_p, r'^&#([0-9]+);$', 1), '') AS BIGINT))")
    return (f"CASE WHEN instr({text}, '&') = 0 THEN {text} ELSE array_join(transform("
            rf"regexp_extract_all({text}, r'&(?:#[0-9]{{1,7}}|#[xX][0-9a-fA-F]{{1,6}}|[a-zA-Z]+);|[^&]++|&', 0), _p -> CASE "
            "WHEN NOT startswith(_p, '&') OR _p = '&' THEN _p "
            f"WHEN {code} BETWEEN 1 AND 1114111 AND {code} NOT BETWEEN 55296 AND 57343 "
            f"THEN decode(unhex(lpad(hex({code}), 8, '0')), 'UTF-32') "
            rf"ELSE coalesce(try_element_at(map({named}), regexp_extract(_p, r'^&([a-zA-Z]+);$', 1)), _p) END), '') END")


def _attribute_pattern(name: str) -> str:
    """Walks over the attributes before the first one of that name; group 1 is its value as written."""
    return (rf"(?is)^<[a-z][^\s/>]*+(?:[\s/]*+(?!{name}[\s=/>])[^\s\x22\x27>/=]++(?:\s*+=\s*+{_VALUE})?+)*+"
            rf"[\s/]*+{name}(?:\s*+=\s*+({_VALUE}))?+(?=[\s/>])")


def has_attribute(tag: str, name: str) -> str:
    return f"({tag} RLIKE r'{_attribute_pattern(name)}')"


def attribute(tag: str, name: str) -> str:
    """Value of an attribute of a start tag (double, single or no quotes); "" without a value or without the attribute."""
    raw = f"regexp_extract({tag}, r'{_attribute_pattern(name)}', 1)"
    return decoded(rf"regexp_replace({raw}, r'(?s)^([\x22\x27])(.*)\1$', '$2')")


def has_class(tag: str, name: str) -> str:
    """The tag's class list holds ``name`` (as a token, not as a part of one)."""
    return f"(contains({tag}, '{name}') AND array_contains(split({attribute(tag, 'class')}, r'\\s+'), '{name}'))"


def first_attribute(toks: str, name: str) -> str:
    """The first non-empty value of an attribute among the tags; "" if there is none."""
    values = f"transform(filter({toks}, _t -> _t ILIKE '<%{name}%'), _t -> {attribute('_t', name)})"
    return f"coalesce(get(filter({values}, _v -> _v <> ''), 0), '')"


def position(toks: str, wanted) -> str:
    """Place (from 1) of the first token for which the SQL ``wanted(token)`` holds, else 0."""
    return f"CAST(array_position(transform({toks}, _t -> {wanted('_t')}), true) AS INT)"


def content(toks: str, at: str) -> str:
    """Text of the element that starts at token ``at`` (from 1) up to its own end tag, or to the end; "" for ``at`` 0."""
    name = tag_name(f"get({toks}, {at} - 1)")
    step = (f"(_a, _t) -> CASE WHEN _a.depth = 0 THEN _a WHEN {is_text('_t')} THEN named_struct('depth', _a.depth, 'text', concat(_a.text, _t), 'name', _a.name) "
            "ELSE named_struct('depth', _a.depth + CASE "
            f"{tag_name('_t')} WHEN _a.name THEN 1 WHEN concat('/', _a.name) THEN -1 ELSE 0 END, 'text', _a.text, 'name', _a.name) END")
    read = (f"aggregate(slice({toks}, {at} + 1, size({toks})), named_struct('depth', CASE WHEN {name} IN ({_list(VOID)}) THEN 0 ELSE 1 END, "
            f"'text', '', 'name', {name}), {step}, _a -> {decoded('_a.text')})")
    return f"CASE WHEN {at} > 0 THEN {read} ELSE '' END"


def outermost(html: str, item: str, lists: tuple[str, ...]) -> str:
    """array<string>: what stands in the outermost ``item`` elements of a page.

    An item ends at its end tag, at the next item of the same level, at the end
    of the list around it, or with the page; items of lists inside it are part
    of it.
    """
    frame = "|".join((item, *lists))
    other = rf"(?:[^<]++|{_SKIPPED}|<(?!/?(?i:{frame})[\s/>])(?:/?[a-zA-Z]{_INSIDE})?+)++"
    toks = rf"regexp_extract_all({html}, r'(?s)</?(?i:{frame})(?=[\s/>]){_INSIDE}|{other}|<', 0)"
    # 1 and 2: start and end of an item; further odd and even numbers: of a list
    kinds = _list([x for n in (item, *lists) for x in (n, f"/{n}")])
    kind = f"array_position(array({kinds}), {tag_name(f'substring(_t, 1, {max(map(len, (item, *lists))) + 3})')})"
    marks = f"filter(transform(_s.toks, (_t, _i) -> named_struct('i', _i, 'kind', {kind})), _m -> _m.kind > 0)"
    flat, ends = "_a.first >= 0 AND _a.depth = 0", "(_m.kind < 3 OR _m.kind % 2 = 0)"
    starts = "_m.kind = 1 AND (_a.first < 0 OR _a.depth = 0)"
    step = (f"(_a, _m) -> named_struct("
            f"'first', CASE WHEN {starts} THEN _m.i WHEN {flat} AND {ends} THEN -1 ELSE _a.first END, "
            f"'depth', CASE WHEN {starts} THEN 0 WHEN _a.first >= 0 AND _m.kind > 2 AND _m.kind % 2 = 1 THEN _a.depth + 1 "
            "WHEN _m.kind > 2 AND _m.kind % 2 = 0 AND _a.depth > 0 THEN _a.depth - 1 ELSE _a.depth END, "
            f"'found', CASE WHEN {flat} AND {ends} THEN array_append(_a.found, named_struct('first', _a.first, 'last', _m.i)) ELSE _a.found END)")
    finish = ("_a -> CASE WHEN _a.first >= 0 THEN array_append(_a.found, named_struct('first', _a.first, 'last', size(_s.toks))) ELSE _a.found END")
    spans = (f"aggregate({marks}, named_struct('first', -1, 'depth', 0, 'found', CAST(array() AS ARRAY<STRUCT<first: INT, last: INT>>)), {step}, {finish})")
    # one struct in an array gives the tokens a name, so that they are made once
    return (f"flatten(transform(array(named_struct('toks', {toks})), _s -> transform({spans}, "
            "_c -> array_join(slice(_s.toks, _c.first + 2, _c.last - _c.first - 1), ''))))")
