"""SQL fragments that several DuckDB checks share."""

#: CTE `crc_tab(t)`: the 256 entries of the CRC-32 table, worked out bit by bit.
CRC_TABLE = """crc_tab AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS v
    FROM range(256) r(i)))"""


def crc32_of_hex(h: str) -> str:
    """CRC-32 of bytes given as hex digits, as BIGINT; needs crc_tab in the FROM clause."""
    codes = f"list_transform(range(0, length({h}) // 2), lambda i: ('0x' || substr({h}, 2 * i + 1, 2))::BIGINT)"
    step = "lambda a, x: xor(crc_tab.t[(xor(a, x) & 255) + 1], a >> 8)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {step}), 4294967295)::BIGINT"


def crc32(text: str) -> str:
    return crc32_of_hex(f"hex(encode({text}))")
