"""GeoJSON geometries as text: what is one, and all kinds to and from well-known text, by expressions on the text of their coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bound import bound

#: Geometries by how deep their coordinates are nested.
DEPTHS = {"Point": 1, "MultiPoint": 2, "LineString": 2, "MultiLineString": 3, "Polygon": 3, "MultiPolygon": 4}
NUMBER = r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"


def _coordinates(depth: int) -> str:
    # a possessive repetition takes no room on the stack, however many positions there are
    inner = rf"{NUMBER}(?:\s*,\s*{NUMBER})++"
    for _ in range(depth - 1):
        inner = rf"(?:\[\s*{inner}\s*\](?:\s*,\s*\[\s*{inner}\s*\])*+)?"
    return rf"^\s*\[\s*{inner}\s*\]\s*$"


def _fits(kind: Column, coordinates: Column, names: dict[str, int]) -> Column:
    """Whether coordinates are nested as a kind's are: each depth has a pattern of its own, which is compiled once."""
    good = F.lit(False)
    for depth in sorted({*names.values()}):
        good = good | (kind.isin(*[n for n, d in names.items() if d == depth]) & coordinates.rlike(_coordinates(depth)))
    return good


def _typed(value: Column) -> Column:
    """The type of a geometry and its coordinates' text."""
    return F.struct(F.try_variant_get(value, "$.type", "string").alias("kind"), F.to_json(F.try_variant_get(value, "$.coordinates", "variant")).alias("text"))


def is_geometry(text: Column) -> Column:
    """Whether a text is a GeoJSON geometry, by its type and the shape of its coordinates; a feature is none."""

    def good(value: Column) -> Column:
        members = F.schema_of_variant(F.try_variant_get(value, "$.geometries", "variant"))
        return bound(_typed(value), lambda x: F.coalesce(_fits(x["kind"], x["text"], DEPTHS) | ((x["kind"] == _COLLECTION) & members.startswith("ARRAY")), F.lit(False)))

    return bound(F.try_parse_json(text), good)


#: Fixed value: the word for a geometry without coordinates.
EMPTY = "EMPTY"
_POSITION = rf"\[({NUMBER}),({NUMBER})(?:,({NUMBER}))?\]"
_COLLECTION = "GeometryCollection"
#: A position in well-known text; what a simple geometry's numbers and parentheses are made of, three deep at most; and one as a member of a collection.
_PLACE = rf"({NUMBER})\s+({NUMBER})(?:\s+({NUMBER}))?"
_NUMBERS = r"[-+0-9.,\seE]++"
_BODY = rf"(?:{EMPTY}|\((?:{_NUMBERS}|\((?:{_NUMBERS}|\((?:{_NUMBERS})?\))*+\))*+\))"
_MEMBER = rf"({'|'.join(sorted(map(str.upper, DEPTHS), reverse=True))})\s*(Z?)\s*({_BODY})"


def _simple_to_wkt(value: Column) -> Column:
    """Of a geometry that is no collection, as a variant: brackets become parentheses, and the commas inside positions spaces; null if it isn't one."""

    def written(kind: Column, text: Column, zs: Column) -> Column:
        positions = F.regexp_count(text, F.lit(_POSITION))
        # positions of a multipoint stand in parentheses of their own, as those of a point do
        alone = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, _POSITION, "<$1 $2 $3>"), " >", ">"), ",", ", ")
        opening, closing = (F.when(kind.isin("Point", "MultiPoint"), x).otherwise("") for x in "()")
        body = F.translate(F.replace(F.replace(alone, F.lit("<"), opening), F.lit(">"), closing), "[]", "()")
        good = _fits(kind, text, DEPTHS) | (kind.isin(*DEPTHS) & (text == "[]"))
        known = good & ((zs == 0) | (zs == positions))
        return F.when(known, F.concat(F.upper(kind), F.when(zs > 0, " Z ").otherwise(" "), F.when(text == "[]", EMPTY).otherwise(body)))

    threes = F.lit(rf"\[{NUMBER},{NUMBER},{NUMBER}\]")
    return bound(_typed(value), lambda x: bound(F.regexp_count(x["text"], threes), lambda zs: written(x["kind"], x["text"], zs)))


def geometry_to_wkt(text: Column) -> Column:
    """Well-known text of a GeoJSON geometry; numbers stay as they are written.

    Positions have two numbers, or all have three (`Z`).  Members of a collection are simple geometries: a collection in a collection,
    and whatever is no geometry, is an error that shows it.
    """

    def gathered(members: Column) -> Column:
        return F.when(F.size(members) == 0, EMPTY).when(~F.exists(members, lambda x: x.isNull()), F.concat(F.lit("("), F.array_join(members, ", "), F.lit(")")))

    def written(value: Column) -> Column:
        collection = bound(F.transform(F.try_variant_get(value, "$.geometries", "array<variant>"), _simple_to_wkt), gathered)
        is_collection = F.try_variant_get(value, "$.type", "string") == _COLLECTION
        return F.when(is_collection, F.concat(F.lit(_COLLECTION.upper() + " "), collection)).otherwise(_simple_to_wkt(value))

    def whole(t: Column) -> Column:
        return F.when(t.isNull(), F.lit(None)).otherwise(F.coalesce(bound(F.try_parse_json(t), written), F.raise_error(F.concat(F.lit("cannot be stored as well-known text: "), t))))

    return bound(text, whole)


def _simple_from_wkt(kind: Column, body: Column) -> Column:
    """GeoJSON of a simple geometry's kind, in capitals, and its part in parentheses."""
    name = F.element_at(F.create_map(*[F.lit(x) for n in DEPTHS for x in (n.upper(), n)]), kind)
    places = F.regexp_replace(F.regexp_replace(body, _PLACE, "[$1,$2,$3]"), r",\]", "]")
    plain = F.regexp_replace(places, r"\s", "")

    def coordinates(plain: Column) -> Column:
        # a point's parentheses, and those of each in a multipoint, are its position's brackets
        own = F.regexp_replace(plain, rf"\((\[{NUMBER},{NUMBER}(?:,{NUMBER})?\])\)", "$1")
        return F.when(F.upper(body) == EMPTY, "[]").otherwise(F.translate(F.when(kind.isin("POINT", "MULTIPOINT"), own).otherwise(plain), "()", "[]"))

    def written(found: Column) -> Column:
        good = (found == "[]") | _fits(kind, found, {n.upper(): d for n, d in DEPTHS.items()})
        return F.when(good, F.concat(F.lit('{"type":"'), name, F.lit('","coordinates":'), found, F.lit("}")))

    return bound(bound(plain, coordinates), written)


def wkt_to_geometry(text: Column) -> Column:
    """The GeoJSON geometry of well-known text, of any of the seven kinds; what is none is an error that shows it."""
    whole, members = rf"^\s*(?i){_MEMBER}\s*$", rf"(?i){_MEMBER}"
    collection = rf"^\s*(?i:{_COLLECTION})\s*(?i:{EMPTY}|\(((?:\s*,?\s*(?i){_MEMBER})*+)\s*\))\s*$"

    def simple(t: Column) -> Column:
        found = F.struct(F.upper(F.regexp_extract(t, whole, 1)).alias("kind"), F.regexp_extract(t, whole, 3).alias("body"))
        return bound(found, lambda x: F.when(x["kind"] != "", _simple_from_wkt(x["kind"], x["body"])))

    def each(inner: Column) -> Column:
        # kinds and parts by two searches of the same members
        return F.zip_with(F.regexp_extract_all(inner, F.lit(members), 1), F.regexp_extract_all(inner, F.lit(members), 3), lambda k, b: bound(F.upper(k), lambda kind: _simple_from_wkt(kind, b)))

    def gathered(found: Column) -> Column:
        return F.when(~F.exists(found, lambda x: x.isNull()), F.concat(F.lit(f'{{"type":"{_COLLECTION}","geometries":['), F.array_join(found, ","), F.lit("]}")))

    def read(t: Column) -> Column:
        of_many = F.when(t.rlike(collection), bound(bound(F.regexp_extract(t, collection, 1), each), gathered))
        return F.when(t.isNull(), F.lit(None)).otherwise(F.coalesce(simple(t), of_many, F.raise_error(F.concat(F.lit("not a geometry: "), t))))

    return bound(text, read)
