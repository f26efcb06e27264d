"""Sizes, spellings and constant signs of primitive kinds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Primitive kind, width in bytes, C spelling.
PRIMITIVES = (
    ("NoType", 0, ""), ("Void", 0, "void"),
    ("Char", 1, "char"), ("UChar", 1, "unsigned char"), ("RChar", 1, "char"),
    ("I8", 1, "char"), ("U8", 1, "unsigned char"), ("Bool8", 1, "bool"),
    ("WChar", 2, "wchar_t"), ("RChar16", 2, "char16_t"), ("RChar32", 4, "char32_t"),
    ("Short", 2, "short"), ("UShort", 2, "unsigned short"), ("I16", 2, "short"), ("U16", 2, "unsigned short"),
    ("Bool16", 2, "bool16"), ("F16", 2, "half"),
    ("Long", 4, "long"), ("ULong", 4, "unsigned long"), ("I32", 4, "int"), ("U32", 4, "unsigned int"),
    ("F32", 4, "float"), ("Bool32", 4, "bool32"), ("HRESULT", 4, "HRESULT"),
    ("Quad", 8, "__int64"), ("UQuad", 8, "unsigned __int64"), ("I64", 8, "__int64"), ("U64", 8, "unsigned __int64"),
    ("F64", 8, "double"), ("Bool64", 8, "bool64"), ("Complex32", 8, "_Complex float"),
    ("Octa", 16, "__int128"), ("UOcta", 16, "unsigned __int128"), ("I128", 16, "__int128"),
    ("U128", 16, "unsigned __int128"), ("F128", 16, "long double"), ("Complex64", 16, "_Complex double"),
)
# Pointer kind and its width in bytes.
INDIRECTIONS = (("Near16", 2), ("Far16", 4), ("Huge16", 4), ("Near32", 4), ("Far32", 6), ("Near64", 8), ("Near128", 16))

# Fixed values: (basic type, width in bytes) and the spelling used by the second reader.
BASIC_NAMES = (
    ("void", 0, "void"), ("char", 1, "char"), ("char8", 1, "char"), ("wchar", 2, "wchar_t"),
    ("char16", 2, "char16_t"), ("char32", 4, "char32_t"),
    ("int", 1, "char"), ("int", 2, "short"), ("int", 4, "int"), ("int", 8, "__int64"), ("int", 16, "__int128"),
    ("uint", 1, "unsigned char"), ("uint", 2, "unsigned short"), ("uint", 4, "unsigned int"),
    ("uint", 8, "unsigned __int64"), ("uint", 16, "unsigned __int128"),
    ("long", 4, "long"), ("long", 8, "__int64"), ("ulong", 4, "unsigned long"), ("ulong", 8, "unsigned __int64"),
    ("float", 2, "half"), ("float", 4, "float"), ("float", 8, "double"), ("float", 16, "long double"),
    ("bool", 1, "bool"), ("bool", 2, "bool16"), ("bool", 4, "bool32"), ("bool", 8, "bool64"),
    ("complex", 8, "_Complex float"), ("complex", 16, "_Complex double"), ("hresult", 4, "HRESULT"),
)


def _lookup(pairs) -> Column:
    return F.create_map(*[F.lit(part) for pair in pairs for part in pair])


def primitive_size(kind: Column, indirection: Column) -> Column:
    """Width in bytes; a pointer kind wins over the kind it points at, an unknown kind is 0."""
    pointer = F.try_element_at(_lookup(INDIRECTIONS), indirection)
    plain = F.try_element_at(_lookup([(name, size) for name, size, _ in PRIMITIVES]), kind)
    return F.coalesce(pointer, plain, F.lit(0)).cast("bigint")


def primitive_name(kind: Column, indirection: Column) -> Column:
    """C spelling, with a star if the index is itself a pointer; '' for an unknown kind."""
    base = F.coalesce(F.try_element_at(_lookup([(name, text) for name, _, text in PRIMITIVES]), kind), F.lit(""))
    return F.when((base != "") & indirection.isNotNull(), F.concat(base, F.lit(" *"))).otherwise(base)


def basic_name(basic: Column, width: Column) -> Column:
    """Spelling by (basic type, width); '' for an unlisted pair."""
    table = _lookup([(f"{name}/{size}", text) for name, size, text in BASIC_NAMES])
    return F.coalesce(F.try_element_at(table, F.concat_ws("/", basic, width.cast("string"))), F.lit(""))


def constant_value(leaf: Column, raw: Column) -> Column:
    """Signed value of a numeric leaf held as ``decimal(20,0)``.

    An 8-bit unsigned leaf carries a signed char, and a 64-bit one wraps to its two's complement.
    """
    half, whole = F.lit("9223372036854775808").cast("decimal(20,0)"), F.lit("18446744073709551616").cast("decimal(20,0)")
    return (F.when((leaf == "U8") & (raw > 127), raw - 256)
            .when((leaf == "U64") & (raw >= half), raw - whole)
            .otherwise(raw).cast("bigint"))
