"""A stand-in for a paged service of five rows."""


def fetch(page: int, size: int, options: dict) -> dict:
    return {"totalFilas": 5, "tamanioPagina": 2, "resultados": [(page, k) for k in range(size)]}
