"""AsciiDoc attributes, directives and a subset of the markup."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom import fixed_values as fv
from docloom.functions.text import bind, drop_attribute_references, line_mode, map_lines


# --- attributes ------------------------------------------------------------


def attribute_entries(
    text: Column,
    defaults: tuple[tuple[str, str], ...] = fv.DEFAULT_ATTRIBUTES,
    across_lines: bool = False,
    shared: Column | None = None,
) -> Column:
    """``array<struct<name, value>>`` in the order of substitution: defaults,
    the ``shared`` array of such structs, the text's own.

    A name keeps the place of its first appearance and the value of its last
    one.  ``across_lines`` lets a definition without a
    value take the next non-empty line as its value.
    """
    pattern = line_mode(fv.ATTRIBUTE_ACROSS_LINES if across_lines else fv.ATTRIBUTE_LINE)
    given = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit(value).alias("value")) for name, value in defaults]
    ).cast("array<struct<name:string,value:string>>")
    own = F.transform(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda line: F.struct(
            F.regexp_extract(line, pattern, 1).alias("name"), F.regexp_extract(line, pattern, 2).alias("value")
        ),
    )

    before = given if shared is None else F.concat(given, shared)
    return bind(F.concat(before, own), _newest)


def _newest(entries: Column) -> Column:
    """Sorted by name and place, the entries of a name are a run: its first one
    gives the place, its last one the value."""

    def of_runs(ordered: Column, starts: Column) -> Column:
        def one(start: Column, run: Column) -> Column:
            end = F.coalesce(F.get(starts, run + 1), F.size(ordered))
            first, last = F.get(ordered, start), F.get(ordered, end - 1)
            return F.struct(first["place"], first["name"].alias("name"), last["value"].alias("value"))

        by_place = F.array_sort(F.transform(starts, one))
        return F.transform(by_place, lambda e: F.struct(e["name"].alias("name"), e["value"].alias("value")))

    def runs(ordered: Column) -> Column:
        def is_start(i: Column) -> Column:
            return (i == 0) | ~F.get(ordered, i - 1)["name"].eqNullSafe(F.get(ordered, i)["name"])

        starts = F.filter(F.transform(ordered, lambda _, i: i), is_start)
        return bind(starts, lambda found: of_runs(ordered, found))

    placed = F.transform(
        entries,
        lambda e, i: F.struct(e["name"].alias("name"), i.alias("place"), e["value"].alias("value")),
    )
    return bind(F.array_sort(placed), runs)


def substitute_in_turn(line: Column, entries: Column) -> Column:
    """Replace ``{name}`` entry by entry, one pass: a reference inside a
    value is resolved only by an entry that comes later.

    What substitution means, at the cost of a search per entry and line; used
    where braces are nested or left open, so that a replacement may complete a
    reference.  Other lines get the same from ``substitute_line``."""
    return F.aggregate(
        entries,
        line,
        lambda done, entry: F.replace(done, F.concat(F.lit("{"), entry["name"], F.lit("}")), entry["value"]),
    )


_REFERENCE = r"\{([^{}]*)\}"


def _only_references(text: Column) -> Column:
    """Whether every brace belongs to a reference without braces inside."""
    return ~F.regexp_replace(text, _REFERENCE, "").rlike("[{}]")


def _position(ordered: Column, key: Column, of: Callable[[Column], Column]) -> Column:
    """Index of the element of an ascending array whose ``of`` is ``key``, by
    halving; null without one."""
    def further(at: Column, halving: Column) -> Column:
        step = at + F.call_function("shiftleft", F.lit(1), halving)
        return F.when(of(F.get(ordered, step)) <= key, step).otherwise(at)

    doublings = F.coalesce(F.ceil(F.log2(F.size(ordered))), F.lit(0)).cast("int")
    below = F.aggregate(F.sequence(doublings, F.lit(0), F.lit(-1)), F.lit(-1), further)
    return bind(below, lambda at: F.when(of(F.get(ordered, at)) == key, at))


def _fill(line: Column, value_of: Callable[[Column], Column]) -> Column:
    """The line cut at its references and put together with their values; a
    reference without a value stays."""

    def piece(text: Column, name: Column) -> Column:
        reference = F.coalesce(value_of(name), F.concat(F.lit("{"), name, F.lit("}")))
        return F.concat(text, F.when(name.isNull(), "").otherwise(reference))

    names = F.regexp_extract_all(line, F.lit(_REFERENCE), F.lit(1))
    return F.array_join(F.zip_with(F.split(line, _REFERENCE), names, piece), "")


#: Entries up to which replacing one after the other is faster than looking
#: references up; the texts are the same either way.
FEW_ATTRIBUTES = 64


def known_attributes(entries: Column, few: int = FEW_ATTRIBUTES) -> Column:
    """``struct<by_name, open, values, simple>`` for looking up references,
    null for no more than ``few`` entries.

    ``by_name`` are the entries sorted by name with their ``place``.  ``open``
    are the places of values that hold references; ``values``, last one first,
    are these values with the references filled in that later entries resolve.
    ``simple`` is false if a name or value is null or has braces that make no
    plain reference.
    """
    by_name = F.array_sort(
        F.transform(
            entries, lambda e, i: F.struct(e["name"].alias("name"), i.alias("place"), e["value"].alias("value"))
        )
    )
    simple = F.forall(
        entries,
        lambda e: F.coalesce(~e["name"].rlike("[{}]") & _only_references(e["value"]), F.lit(False)),
    )
    places = F.transform(entries, lambda e, i: F.struct(i.alias("place"), e["value"].alias("value")))
    with_references = F.filter(places, lambda e: F.contains(e["value"], F.lit("{")))

    def resolved(names: Column, holders: Column) -> Column:
        spots = F.transform(holders, lambda e: e["place"])

        def values(spot: Column) -> Column:
            return F.aggregate(
                F.reverse(holders),
                F.array().cast("array<string>"),
                lambda done, e: F.concat(
                    done, F.array(_fill(e["value"], lambda name: _value(name, names, spot, done, e["place"])))
                ),
            )

        return bind(
            spots,
            lambda spot: F.struct(
                names.alias("by_name"),
                spot.alias("open"),
                F.when(simple, values(spot)).alias("values"),
                simple.alias("simple"),
            ),
        )

    known = bind(by_name, lambda names: bind(with_references, lambda holders: resolved(names, holders)))
    return F.when(F.size(entries) > few, known)


def _value(name: Column, by_name: Column, spots: Column, values: Column, after: Column) -> Column:
    """Value of a name for a reference in the value at place ``after``, -1 for
    one in the text."""

    def of_entry(entry: Column) -> Column:
        closed = ~F.contains(entry["value"], F.lit("{"))
        filled = F.get(values, F.size(spots) - 1 - _position(spots, entry["place"], lambda spot: spot))
        return F.when(entry["place"] > after, F.when(closed, entry["value"]).otherwise(filled))

    return bind(F.get(by_name, _position(by_name, name, lambda e: e["name"])), of_entry)


def substitute_line(line: Column, entries: Column, known: Column) -> Column:
    """What ``substitute_in_turn`` gives; ``known`` are the
    ``known_attributes`` of the entries.  A line costs its length and a search
    by halving for each of its references."""

    def value_of(name: Column) -> Column:
        return _value(name, known["by_name"], known["open"], known["values"], F.lit(-1))

    plain = known["simple"] & _only_references(line)
    filled = F.when(plain, _fill(line, value_of)).otherwise(substitute_in_turn(line, entries))
    return F.when(F.contains(line, F.lit("{")), filled).otherwise(line)


def substitute_attributes(text: Column, entries: Column, few: int = FEW_ATTRIBUTES) -> Column:
    """The same for a text.  Neither names nor values hold a line feed, so
    lines are independent of each other."""

    def lines(given: Column, known: Column) -> Column:
        return map_lines(text, lambda line: substitute_line(line, given, known))

    return bind(entries, lambda given: bind(known_attributes(given, few), lambda known: lines(given, known)))


# --- directives ------------------------------------------------------------
#
# All but one work on single lines.  Looking at the start of a line is far
# cheaper than trying a pattern at every character of the text.


def blank_include(line: Column) -> Column:
    return F.when(F.startswith(line, F.lit(fv.INCLUDE_START)), "").otherwise(line)


def blank_conditional(line: Column) -> Column:
    """Only the directive goes; what it encloses always stays."""
    directive = F.lit(False)
    for start in fv.CONDITIONAL_STARTS:
        directive = directive | F.startswith(line, F.lit(start))
    return F.when(directive, "").otherwise(line)


def blank_definition(line: Column) -> Column:
    definition = F.startswith(line, F.lit(":")) & line.rlike(fv.DEFINITION_START)
    return F.when(definition, "").otherwise(line)


def drop_block_ids(text: Column) -> Column:
    """Blank lines behind the block id go with it."""
    dropped = F.regexp_replace(text, line_mode(fv.BLOCK_ID_LINE), "")
    return F.when(F.contains(text, F.lit('[id="')), dropped).otherwise(text)


def clean_asciidoc(text: Column, entries: Column | None = None) -> Column:
    """Attributes resolved, ``include`` lines blanked, block ids removed,
    conditional and definition lines blanked, in this order.

    ``entries`` replaces the attributes read from the text, e.g. when a
    shared table adds some.
    """

    def resolved(entries: Column, known: Column) -> Column:
        def line_done(line: Column) -> Column:
            without = drop_attribute_references(substitute_line(line, entries, known))
            return F.when(F.contains(line, F.lit("{")), bind(without, blank_include)).otherwise(blank_include(line))

        return map_lines(text, line_done)

    own = attribute_entries(text) if entries is None else entries
    resolved_text = F.when(
        F.contains(text, F.lit("{")),
        bind(own, lambda given: bind(known_attributes(given), lambda known: resolved(given, known))),
    ).otherwise(map_lines(text, blank_include))
    return map_lines(
        bind(resolved_text, drop_block_ids), lambda line: blank_definition(blank_conditional(line))
    )


# --- markup ----------------------------------------------------------------

# A block opens at the first line of marks and closes at one of the same length;
# what lies between is no markup.  A listing that is never closed reaches to the
# end, other marks without a partner are text.
_BLOCK = line_mode(
    r"^(?:(-{4,})[ \t]*$(?s:.*?)(?:^\1[ \t]*$|\z)|(\.{4,}|/{4,}|\|={3,})[ \t]*$(?s:.*?)^\2[ \t]*$)"
)
# The attributes right in front of a table; the groups are its columns.
_TABLE_LINE = line_mode(r"^\[[^\[\]\n]*\]\n\z")
_COLUMNS = r'cols="([^"]*)"'
_REPEATED = r"^([0-9]{1,3})\*$"
# A source line right in front of a listing; the group is its language.
_SOURCE_LINE = line_mode(r"^\[source,[ \t]*([A-Za-z0-9_+#-]+)[^\]\n]*\]\n\z")
_IMAGE = r"^image::([^\s\[\]]+)\[([^\],\n]*)[^\]\n]*\][ \t]*$"
_XREF_FILE = r"xref:([^\s\[\]]*[.#][^\s\[\]]*)\[([^\]\n]+)\]"
_XREF = r"xref:([^\s\[\]]+)\[([^\]\n]+)\]"
_NAMED_ANCHOR = r"<<([^\s<>,]+),[ ]*([^<>\n]+)>>"
_ANCHOR = r"<<([^\s<>,]+)>>"
_LINK = r"link:([^\s\[\]]+)\[([^\]\n]+)\]"
_BARE_LINK = r"link:([^\s\[\]]+)\[\]"
_URL = r"(?<![\w:])(https?://[^\s\[\]<>]+)\[([^\]\n]+)\]"
_BARE_URL = r"(?<![\w:])(https?://[^\s\[\]<>]+)\[\]"


def _leading(line: Column, marks: str) -> Column:
    """Length of the run of ``marks`` in front of a blank, else 0."""
    return F.length(F.regexp_extract(line, f"^({marks}) ", 1))


def _list_item(line: Column, mark: str, indent: str, bullet: str) -> Column:
    text = F.regexp_replace(line, rf"^{mark}+ +", "")
    return bind(
        _leading(line, f"{mark}+"),
        lambda level: F.when(level == 0, line).otherwise(
            F.concat(F.repeat(F.lit(indent), level - 1), F.lit(bullet), text)
        ),
    )


def _title(line: Column) -> Column:
    return bind(
        _leading(line, "={1,6}"),
        lambda level: F.concat(F.repeat(F.lit("#"), level), F.substr(line, level + 1)),
    )


def _links(line: Column) -> Column:
    line = F.regexp_replace(line, _LINK, "[$2]($1)")
    line = F.regexp_replace(line, _BARE_LINK, "<$1>")
    line = F.regexp_replace(line, _URL, "[$2]($1)")
    return F.regexp_replace(line, _BARE_URL, "<$1>")


def _references(line: Column) -> Column:
    line = F.regexp_replace(line, _XREF_FILE, "[$2]($1)")
    line = F.regexp_replace(line, _XREF, "[$2](#$1)")
    line = F.regexp_replace(line, _NAMED_ANCHOR, "[$2](#$1)")
    return F.regexp_replace(line, _ANCHOR, "[$1](#$1)")


def _inline(line: Column) -> Column:
    """References and links; one pattern runs only where its literal is."""
    refers = F.contains(line, F.lit("xref:")) | F.contains(line, F.lit("<<"))
    linked = F.contains(line, F.lit("link:")) | F.contains(line, F.lit("://"))

    def links(text: Column) -> Column:
        return F.when(linked, _links(text)).otherwise(text)

    return F.when(refers, bind(_references(line), links)).otherwise(links(line))


def _prose_line(line: Column) -> Column:
    def starts(mark: str) -> Column:
        return F.startswith(line, F.lit(mark))

    marked = (
        F.when(starts("="), _title(line))
        .when(starts("*"), _list_item(line, r"\*", "  ", "- "))
        .when(starts("."), _list_item(line, r"\.", "   ", "1. "))
        .when(starts("image::"), F.regexp_replace(line, _IMAGE, "![$2]($1)"))
        .otherwise(line)
    )
    has_inline = F.lit(False)
    for literal in ("link:", "://", "xref:", "<<"):
        has_inline = has_inline | F.contains(line, F.lit(literal))
    return F.when(has_inline & ~starts("image::"), bind(marked, _inline)).otherwise(marked)


def _prose_to_markdown(text: Column) -> Column:
    return map_lines(text, _prose_line)


def _listing_to_fence(language: Column, body: Column) -> Column:
    """The fence is longer than any run of its mark in the listing."""
    closed = F.when(F.endswith(body, F.lit("\n")), body).otherwise(F.concat(body, F.lit("\n")))
    runs = F.transform(F.regexp_extract_all(body, F.lit("(`{3,})"), F.lit(1)), F.length)
    marks = F.repeat(F.lit("`"), F.coalesce(F.array_max(runs) + 1, F.lit(3)))
    return bind(marks, lambda fence: F.concat(fence, language, closed, fence))


def _column_count(attributes: Column, body: Column) -> Column:
    """As the attributes tell, else the cells of the first line with any."""
    told = F.regexp_extract(attributes, _COLUMNS, 1)
    repeated = F.regexp_extract(told, _REPEATED, 1)
    first = F.regexp_extract(body, r"([^\n]*\|[^\n]*)", 1)
    return F.greatest(
        F.when(repeated != "", repeated.cast("int"))
        .when(told != "", F.size(F.split(told, ",")))
        .otherwise(F.size(F.split(first, r"\|")) - 1),
        F.lit(1),
    )


def _table(attributes: Column, block: Column) -> Column:
    """Cells in rows; the first row is the head, which Markdown asks for.  An
    escaped bar stays one.  A table without cells stays as it is."""
    kept = F.replace(block, F.lit("\\|"), F.lit("\x01"))
    inside = F.regexp_replace(kept, r"\A\|=+[ \t]*|\|=+[ \t]*\z", "")

    def cell(text: Column) -> Column:
        flat = F.regexp_replace(F.trim(text, F.lit(" \t\n")), r"[ \t]*\n\s*", " ")
        return F.replace(bind(flat, _inline), F.lit("\x01"), F.lit("\\|"))

    def rows(parts: Column, width: Column) -> Column:
        cells = F.transform(F.slice(parts, 2, F.size(parts) - 1), cell)

        def lines(done: Column) -> Column:
            starts = F.sequence(F.lit(1), F.size(done), width)
            listed = F.transform(
                starts, lambda i: F.concat(F.lit("| "), F.array_join(F.slice(done, i, width), " | "), F.lit(" |"))
            )
            rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), width))
            return bind(
                listed,
                lambda all_rows: F.array_join(
                    F.concat(F.slice(all_rows, 1, 1), F.array(rule), F.slice(all_rows, 2, F.size(all_rows))), "\n"
                ),
            )

        return F.when(F.size(parts) > 1, bind(cells, lines)).otherwise(block)

    return bind(
        inside, lambda body: bind(_column_count(attributes, body), lambda width: bind(F.split(body, r"\|"), lambda parts: rows(parts, width)))
    )


def asciidoc_to_markdown(text: Column) -> Column:
    """A documented subset, applied to cleaned AsciiDoc.

    Titles of level 0 to 5, ``*`` and ``.`` lists of any depth, ``----``
    listings with an optional ``[source,lang]`` line and ``....`` literals as
    fences, ``|===`` tables as rows of cells, ``image::`` lines, ``link:``,
    ``xref:``, ``<<anchor>>`` and URL macros; ``////`` comments go.  All other
    markup is passed through.  Blocks close only with their own marks, of their
    own length, and are left verbatim but for tables; a listing that is never
    closed reaches to the end of the document.
    """

    def piece(prose: Column, block: Column) -> Column:
        listing = F.startswith(block, F.lit("-")) | F.startswith(block, F.lit("."))
        table = F.startswith(block, F.lit("|"))
        body = F.regexp_replace(block, line_mode(r"\A([-.])\1*[ \t]*$|^([-.])\2{3,}[ \t]*\z"), "")
        before = (
            F.when(listing, F.regexp_replace(prose, _SOURCE_LINE, ""))
            .when(table, F.regexp_replace(prose, _TABLE_LINE, ""))
            .otherwise(prose)
        )
        shown = (
            F.when(listing, _listing_to_fence(F.regexp_extract(prose, _SOURCE_LINE, 1), body))
            .when(table, _table(F.regexp_extract(prose, _TABLE_LINE, 0), block))
            .otherwise("")
        )
        return F.concat(bind(before, _prose_to_markdown), shown)

    def document(body: Column) -> Column:
        marks = F.lit(False)
        for mark in ("----", "....", "////", "|==="):
            marks = marks | F.contains(body, F.lit(mark))
        blocks = F.regexp_extract_all(body, F.lit(_BLOCK), F.lit(0))
        pieces = F.zip_with(F.split(body, _BLOCK), blocks, piece)
        return F.when(marks, F.array_join(pieces, "")).otherwise(_prose_to_markdown(body))

    return bind(text, document)
