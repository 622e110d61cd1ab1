"""The same base tables as SQL, for the answers."""

from __future__ import annotations

from patio.workload.domain import CONCEPT_ROWS

_ACCOUNT = "lpad(CAST({} AS VARCHAR), 22, '0')"

TABLES: dict[str, str] = {
    "consorcio": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS nombre,
               'Calle ' || n_nationkey AS domicilio,
               CAST(n_nationkey + 10 AS INTEGER) AS cantidadUnidades,
               CAST(n_nationkey * 10 + 1000 AS INTEGER) AS m2totales
        FROM nation""",
    "uf": f"""
        SELECT c_custkey AS idUF, CAST(c_nationkey AS BIGINT) AS idConsorcio,
               c_custkey AS numeroUnidad, CAST(c_custkey % 12 AS SMALLINT) AS piso,
               c_mktsegment AS departamento,
               CAST((c_custkey % 50) * 0.1 AS DECIMAL(3,1)) AS coeficiente,
               CAST(20 + c_custkey % 97 AS INTEGER) AS m2_UF,
               CASE WHEN c_custkey % 10 = 0 THEN NULL
                    WHEN c_custkey % 10 = 2 THEN {_ACCOUNT.format('c_custkey - 1')}
                    ELSE {_ACCOUNT.format('c_custkey')} END AS cbu_cvu_actual
        FROM customer""",
    "accesoria": """
        SELECT c_custkey AS idUnidadFuncional,
               (c_nationkey % 3 = 0 AND c_custkey % 5 = 0) AS cochera,
               (c_nationkey % 2 = 0 AND c_custkey % 3 = 0) AS baulera,
               CAST(c_custkey % 7 AS INTEGER) AS m2_baulera,
               CAST(c_custkey % 13 AS INTEGER) AS m2_cochera
        FROM customer WHERE c_mktsegment <> 'BUILDING'""",
    "pago": f"""
        SELECT o_orderkey AS idDePago,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS nroUnidadFuncional,
               CAST(o_orderdate AS DATE) AS fechaPago, {_ACCOUNT.format('o_custkey')} AS cbu,
               CAST(o_totalprice AS DECIMAL(18,2)) AS monto
        FROM orders""",
    "linea": """
        SELECT o_custkey * 100000 + year(o_orderdate) * 12 + month(o_orderdate) - 1 AS idExpensa,
               o_custkey AS idUF, CAST(date_trunc('month', o_orderdate) AS DATE) AS periodo,
               l_suppkey AS idPrestadorServicio, CAST(l_extendedprice AS DECIMAL(18,2)) AS importe,
               CASE l_returnflag WHEN 'R' THEN 'Extraordinario' WHEN 'A' THEN 'Ordinario' END AS tipo,
               CASE l_returnflag WHEN 'R' THEN 'EXTRAORDINARIO' ELSE 'ORDINARIO' END AS categoria,
               l_linenumber, c_nationkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN customer ON c_custkey = o_custkey""",
    "detalle": "SELECT idExpensa, idPrestadorServicio, importe, tipo, categoria FROM linea",
    "expensa": """
        SELECT idExpensa AS id, idUF, periodo, CAST(sum(importe) AS DECIMAL(18,2)) AS montoTotal
        FROM linea GROUP BY idExpensa, idUF, periodo""",
    "prestador": """
        SELECT s_suppkey AS id, CAST(s_nationkey AS BIGINT) AS idConsorcio, s_name AS nombre,
               'servicio ' || (s_suppkey % 7) AS tipoServicio,
               lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS cuenta
        FROM supplier""",
    "persona": f"""
        SELECT c_custkey AS id, c_name AS nombre, c_mktsegment AS apellido,
               c_custkey + 10000000 AS dni, lower(c_name) || '@mail.org' AS email,
               lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS telefono,
               {_ACCOUNT.format('c_custkey')} AS cbu_cvu,
               CASE WHEN c_custkey % 2 = 1 THEN 'Inquilino' ELSE 'Propietario' END AS tipoTitularidad
        FROM customer""",
    "feriado": """
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS fecha, 'inamovible' AS tipo,
               'Feriado ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS nombre
        FROM orders WHERE day(o_orderdate) IN (1, 2, 9, 25)""",
    "concepto": "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{a}', '{b}', '{c}')" for i, (a, b, c) in enumerate(CONCEPT_ROWS))
    + ") AS t(orden, concepto, tipoServicio, categoria)",
    # Lowest unit of each account.
    "titular": """
        SELECT cbu_cvu_actual AS cbu, min(idUF) AS idUF, count(*) AS unidades
        FROM uf WHERE cbu_cvu_actual IS NOT NULL GROUP BY cbu_cvu_actual""",
    "pagos_mes": """
        SELECT nroUnidadFuncional AS idUF, CAST(date_trunc('month', fechaPago) AS DATE) AS periodo,
               sum(monto) AS pagos
        FROM pago WHERE nroUnidadFuncional IS NOT NULL GROUP BY 1, 2""",
    # Running balance of every charge.
    "historia": """
        SELECT e.id AS idExpensa, e.idUF, e.periodo,
               CAST(coalesce(sum(e.montoTotal - coalesce(p.pagos, 0)) OVER (PARTITION BY e.idUF
                    ORDER BY e.periodo ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                    AS DECIMAL(18,2)) AS saldoAnterior,
               CAST(sum(e.montoTotal - coalesce(p.pagos, 0)) OVER (PARTITION BY e.idUF
                    ORDER BY e.periodo) AS DECIMAL(18,2)) AS saldoNuevo
        FROM expensa e LEFT JOIN pagos_mes p USING (idUF, periodo)""",
    # Amounts of each building, month and concept, as the raw records carry them.
    "monto": """
        SELECT CAST(c_nationkey AS BIGINT) AS idConsorcio, periodo, l_linenumber - 1 AS orden,
               CAST(max(importe) AS DECIMAL(12,2)) AS monto
        FROM linea GROUP BY 1, 2, 3""",
    "area": """
        SELECT idUF, any_value(idConsorcio) AS idConsorcio, sum(pieza) AS m2
        FROM (SELECT idUF, idConsorcio, m2_UF AS pieza FROM uf
              UNION ALL SELECT idUnidadFuncional, NULL, m2_baulera FROM accesoria
              UNION ALL SELECT idUnidadFuncional, NULL, m2_cochera FROM accesoria)
        GROUP BY idUF""",
    # Percent in 1e-12 and shares in cents are whole numbers, rounded half up.
    "parte": """
        SELECT a.idUF, a.idConsorcio, m.periodo, m.orden,
               CAST((CAST(m.monto * 100 AS HUGEINT) * x.pct + 50000000000000) // 100000000000000 AS BIGINT) AS centavos
        FROM (SELECT idUF, idConsorcio,
                     (CAST(m2 AS HUGEINT) * 100000000000000 + sum(m2) OVER w // 2) // sum(m2) OVER w AS pct
              FROM area WINDOW w AS (PARTITION BY idConsorcio)) x
        JOIN area a USING (idUF) JOIN monto m ON m.idConsorcio = a.idConsorcio""",
}

_NEEDS: dict[str, tuple[str, ...]] = {
    "detalle": ("linea",),
    "expensa": ("linea",),
    "titular": ("uf",),
    "pagos_mes": ("pago",),
    "historia": ("expensa", "pagos_mes"),
    "monto": ("linea",),
    "area": ("uf", "accesoria"),
    "parte": ("area", "monto"),
}


def answer(names: str, body: str) -> str:
    """`body` with the base tables it names in front."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, ()):
            add(need)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    if not order:
        return body.strip()
    parts = ",\n".join(f"{n} AS ({TABLES[n].strip()})" for n in order)
    joiner = ",\n" if body.lstrip().upper().startswith("WITH ") else "\n"
    rest = body.strip()[5:] if joiner == ",\n" else body.strip()
    return f"WITH {parts}{joiner}{rest}"
