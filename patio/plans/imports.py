"""Import jobs: raw text rows in, next table states and rejects out.

Each job keeps exactly the rows the cleaning rules accept. Everything else comes back as
rejects with a reason, the row as JSON text and its number of copies.

The dimension imports store their cleaned change set once: updates, inserts and follow-up
tables all read it, and the raw text is not parsed again for each.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patio.functions import dates, keys, numbers, text
from patio.operators import dedup, identity, joins, quality, upsert
from patio.operators.shape import code_ended, computed_once
from patio.schemas import CONCEPTS, RAW_CHARGES
from patio.session import materialize


class ChargeImport(NamedTuple):
    charges: DataFrame
    details: DataFrame
    rejects: DataFrame


class PaymentImport(NamedTuple):
    payments: DataFrame
    shared_accounts: DataFrame
    rejects: DataFrame


class TableImport(NamedTuple):
    table: DataFrame
    inserted: DataFrame
    rejects: DataFrame


class UnitAccountImport(NamedTuple):
    units: DataFrame
    changed: DataFrame
    rejects: DataFrame


class UnitImport(NamedTuple):
    units: DataFrame
    accessories: DataFrame
    changed: DataFrame
    rejects: DataFrame


UNKNOWN_GROUP = "grupo desconocido"
REPEATED = "clave repetida"
UNREADABLE = "importe ilegible"
RAW_ROW = "fila"


def _raw_row(raw: DataFrame) -> Column:
    """The raw row as JSON text; Spark only computes it where rejects are read."""
    return F.to_json(F.struct(*[f"`{c}`" for c in raw.columns])).alias(RAW_ROW)


def _typed(df: DataFrame) -> DataFrame:
    return df.drop(RAW_ROW)


def _rejects(df: DataFrame, reason: Column, copies: Column | None = None) -> DataFrame:
    plain = [f"`{c}`" for c in df.columns if c not in (quality.REASON, "copias")]
    return df.select(
        reason.alias(quality.REASON),
        (F.col(RAW_ROW) if RAW_ROW in df.columns else F.to_json(F.struct(*plain))).alias(RAW_ROW),
        (copies if copies is not None else F.lit(1)).cast("bigint").alias("copias"),
    )


def _invalid(df: DataFrame) -> DataFrame:
    return _rejects(df, F.col(quality.REASON))


def _repeated(df: DataFrame, copies: Column | None = None) -> DataFrame:
    return _rejects(df, F.lit(REPEATED), copies)


def _known(column: str) -> Column:
    return F.col(column).isNotNull()


def _readable(concept: str) -> Column:
    """The amount is missing or can be read; text that cannot must not become nothing."""
    raw = F.col(f"`{concept}`")
    return F.coalesce(F.trim(raw) == "", F.lit(True)) | numbers.mixed_locale_amount(raw).isNotNull()


# ---------------------------------------------------------------------------- monthly charges


def monthly_amounts(
    raw: DataFrame, groups: DataFrame, year: int | Column
) -> tuple[DataFrame, DataFrame]:
    """(group, month and seven amounts, rejects). One record per group and month."""
    named = joins.group_by_name(raw, F.col(f"`{RAW_CHARGES[0]}`"), groups, "left")
    typed = named.withColumn(RAW_ROW, _raw_row(raw)).withColumn("periodo", dates.period_of(year, dates.month_number(F.col("Mes"))))
    good, bad = quality.split_valid(
        typed,
        {
            UNKNOWN_GROUP: _known("idConsorcio"),
            "mes desconocido": _known("periodo"),
            UNREADABLE: reduce(lambda a, b: a & b, map(_readable, CONCEPTS)),
        },
    )
    amounts = good.select(
        "idConsorcio",
        "periodo",
        *[numbers.mixed_locale_amount(F.col(f"`{c}`")).alias(c) for c in CONCEPTS],
    )
    key = ["idConsorcio", "periodo"]
    rejects = _invalid(bad).unionByName(_repeated(dedup.rows_of_repeated(good.select(*key, RAW_ROW), key)))
    return dedup.drop_repeated(amounts, key), rejects


def unit_areas(units: DataFrame, accessories: DataFrame) -> DataFrame:
    """Floor area of each unit with its storage and parking."""
    extra = accessories.groupBy(F.col("idUnidadFuncional").alias("idUF")).agg(
        F.sum(F.col("m2_baulera") + F.col("m2_cochera")).alias("_extra")
    )
    area = F.col("m2_UF") + F.coalesce(F.col("_extra"), F.lit(0))
    return (
        units.select("idUF", "idConsorcio", "m2_UF")
        .join(extra, "idUF", "left")
        .select("idUF", "idConsorcio", area.cast("bigint").alias("m2"))
    )


#: Building-months that are broadcast at most; each has seven amounts, about 200 bytes in all.
MOST_MONTHS = 100_000
#: Parts that the units of a building are dealt to where there are more building-months.
UNIT_PARTS = 64
#: Lines that one task makes at about most, half a minute of work, and how many lines the shares of
#: a unit and month cost.
LINES_A_TASK = 200_000_000
LINES_A_PAIR = 16


def months_and_lines(amounts: DataFrame, units: DataFrame, offers: DataFrame | None) -> tuple[int, int]:
    """Building-months, and the work of their units in lines; `offers` has a row per line of a pair."""
    tables = [amounts, units] + ([offers] if offers is not None else [])
    names = ["_meses", "_unidades", "_ofertas"]
    rows = [
        df.select("idConsorcio", *[F.lit(int(i == j)).alias(name) for j, name in enumerate(names)])
        for i, df in enumerate(tables)
    ]
    sizes = reduce(DataFrame.unionAll, rows).groupBy("idConsorcio").agg(*[F.sum(n).alias(n) for n in names])
    work = F.col("_meses") * F.col("_unidades") * (F.col("_ofertas") + LINES_A_PAIR)
    months, lines = sizes.agg(F.sum("_meses"), F.sum(work)).first()
    return months or 0, lines or 0


def allocate(
    amounts: DataFrame,
    units: DataFrame,
    accessories: DataFrame,
    known: DataFrame | None = None,
    offers: DataFrame | None = None,
) -> DataFrame:
    """Each unit's rounded share of the seven amounts, by floor area.

    The exact fraction is found once per unit. Units meet the months they already have in `known`
    (one date a month) and are dealt over tasks; then they meet the amounts, and pairs of unit and
    month are not shuffled. Adaptive sizing would only see the small input, so the tasks are a
    multiple of the shuffle partitions, by the lines that shares give with `offers`: a single long
    task a core has no one to share its rest with.
    The months are stored and counted: up to MOST_MONTHS of them are broadcast; beyond that the
    units of each building are dealt to parts, and every part gets the months of the building.
    """
    areas = unit_areas(units, accessories)
    whole = areas.groupBy("idConsorcio").agg(F.sum("m2").alias("_m2"))
    amounts = materialize(amounts)
    building_months, lines = months_and_lines(amounts, units, offers)
    tasks = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks *= max(1, -(-lines // (LINES_A_TASK * tasks)))
    parts = areas.join(whole, "idConsorcio").select(
        "idUF", "idConsorcio", numbers.fraction_of(F.col("m2"), F.col("_m2")).alias("_parte")
    )
    if known is not None:
        months_of = known.groupBy("idUF").agg(F.collect_set("periodo").alias("_meses"))
        parts = parts.join(months_of, "idUF", "left")
    shares = [numbers.apply_fraction(F.col(f"`{c}`"), F.col("_parte")).alias(c) for c in CONCEPTS]
    if building_months <= MOST_MONTHS:
        # By idUF alone, the last join would stand for this exchange, which adaptive sizing then shrinks.
        rows = parts.repartition(tasks, "idUF", "idConsorcio").join(F.broadcast(amounts), "idConsorcio")
    else:
        place = ["idConsorcio", "_lote"]
        dealt = parts.withColumn("_lote", F.pmod(F.hash("idUF"), F.lit(UNIT_PARTS)))
        months = amounts.withColumn("_lote", F.explode(F.sequence(F.lit(0), F.lit(UNIT_PARTS - 1))))
        rows = dealt.repartition(tasks, *place).join(months.repartition(tasks, *place), place)
    if known is not None:
        rows = rows.filter(~F.coalesce(F.array_contains("_meses", F.col("periodo")), F.lit(False)))
    return code_ended(computed_once(rows, [F.col("idUF"), F.col("idConsorcio"), F.col("periodo"), *shares]))


def _total(shares: DataFrame) -> Column:
    total = F.lit(0).cast("decimal(18,2)")
    for c in CONCEPTS:
        total = total + F.col(f"`{c}`")
    return total.cast("decimal(18,2)")


def by_concept(shares: DataFrame) -> DataFrame:
    """Wide shares as one row per unit, month and concept with a positive amount."""
    ids = [c for c in shares.columns if c not in CONCEPTS]
    long = shares.unpivot(ids, [f"`{c}`" for c in CONCEPTS], "concepto", "importe")
    return long.filter("importe > 0")


def concept_offers(providers: DataFrame, concept_map: DataFrame) -> DataFrame:
    """Who serves each concept in each building, from the concept's service type."""
    kinds = concept_map.select(
        "concepto",
        F.col("tipoServicio").alias("tipo"),
        "categoria",
        keys.match_key(F.col("tipoServicio")).alias("_tipo"),
    )
    return providers.select(
        F.col("id").alias("idPrestadorServicio"),
        "idConsorcio",
        keys.match_key(F.col("tipoServicio")).alias("_tipo"),
    ).join(kinds, "_tipo").drop("_tipo")


#: Offers that are broadcast at most, and how many a list of them holds.
MOST_OFFERS = 1_000_000
OFFERS_A_LIST = 1_000


def offer_lists(providers: DataFrame, concept_map: DataFrame) -> DataFrame:
    """Offers with the providers of a building and concept in lists of about OFFERS_A_LIST.

    A broadcast hint is given where the offers, which are counted, are at most MOST_OFFERS.
    """
    offers = concept_offers(providers, concept_map)
    key = ["idConsorcio", "concepto"]
    sizes = offers.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / OFFERS_A_LIST).alias("_listas"))
    part = F.pmod(F.xxhash64("idPrestadorServicio"), F.col("_listas")).alias("_lista")
    # As structs, so that an unknown number is kept, too.
    numbers_of = F.collect_list(F.struct("idPrestadorServicio"))["idPrestadorServicio"]
    lists = (
        offers.join(sizes, key)
        .groupBy(*key, "tipo", "categoria", part)
        .agg(numbers_of.alias("_prestadores"))
        .drop("_lista")
    )
    return F.broadcast(lists) if offers.count() <= MOST_OFFERS else lists


def detail_lines(shares: DataFrame, providers: DataFrame, concept_map: DataFrame) -> DataFrame:
    """Charge lines for each provider of the concept's service type in the building.

    A concept without provider has no line and one with two providers has two. Lines are many more
    than shares, so all that is the same for every provider is done before: concepts meet the
    providers, a share meets lists of them, and the lists are spread last. The code that is
    generated for the lines is kept apart, so that it holds those of one share and not of a unit.
    """
    ids = code_ended(shares).select(
        keys.charge_id(F.col("idUF"), F.col("periodo")).alias("idExpensa"),
        "idConsorcio",
        "periodo",
        *[F.col(f"`{c}`").cast("decimal(18,2)").alias(c) for c in CONCEPTS],
    )
    served = code_ended(by_concept(ids)).join(offer_lists(providers, concept_map), ["idConsorcio", "concepto"])
    return served.select(
        "idExpensa",
        F.explode("_prestadores").alias("idPrestadorServicio"),
        "importe",
        F.lit(None).cast("string").alias("nroFactura"),
        "tipo",
        "categoria",
        "periodo",
    )


def import_charges(
    raw: DataFrame,
    groups: DataFrame,
    units: DataFrame,
    accessories: DataFrame,
    providers: DataFrame,
    concept_map: DataFrame,
    charges: DataFrame,
    year: int | Column,
) -> ChargeImport:
    """New charges with their lines; a unit that already has the month is left alone."""
    amounts, rejects = monthly_amounts(raw, groups, year)
    shares = allocate(amounts, units, accessories, charges, concept_offers(providers, concept_map))
    fresh, empty = quality.split_valid(shares, {"total no positivo": _total(shares) > 0})
    rows = fresh.select(
        keys.charge_id(F.col("idUF"), F.col("periodo")).alias("id"),
        "idUF",
        "periodo",
        _total(fresh).alias("montoTotal"),
    )
    return ChargeImport(
        upsert.shaped_like(charges, rows),
        detail_lines(fresh, providers, concept_map),
        rejects.unionByName(_invalid(empty)),
    )


def allocation_residual(
    amounts: DataFrame,
    units: DataFrame,
    accessories: DataFrame,
    providers: DataFrame,
    concept_map: DataFrame,
) -> DataFrame:
    """Per building and month: its total, the sum of the rounded shares and of the lines."""
    key = ["idConsorcio", "periodo"]
    shares = allocate(amounts, units, accessories)
    building = amounts.select(
        *key, sum_of([F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in CONCEPTS]).alias("total")
    )
    shared = shares.groupBy(*key).agg(F.sum(_total(shares)).alias("repartido"))
    # Lines are counted per building, month and concept before providers repeat them.
    per_concept = by_concept(shares).groupBy(*key, "concepto").agg(F.sum("importe").alias("importe"))
    offers = (
        concept_offers(providers, concept_map)
        .groupBy("idConsorcio", "concepto")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    lines = (
        per_concept.join(offers, ["idConsorcio", "concepto"])
        .groupBy(*key)
        .agg(F.sum(F.col("importe") * F.col("_n").cast("decimal(10,0)")).alias("detallado"))
    )
    zero = F.lit(0).cast("decimal(18,2)")
    total, part = F.col("total").cast("decimal(28,2)"), F.coalesce("repartido", zero).cast("decimal(28,2)")
    line = F.coalesce("detallado", zero).cast("decimal(28,2)")
    return (
        building.join(shared, key, "left")
        .join(lines, key, "left")
        .select(
            *key,
            total.alias("total"),
            part.alias("repartido"),
            line.alias("detallado"),
            (part - total).alias("resto_reparto"),
            (line - part).alias("resto_detalle"),
        )
    )


def sum_of(columns: list[Column]) -> Column:
    total = F.lit(0).cast("decimal(18,2)")
    for c in columns:
        total = total + c
    return total


# ---------------------------------------------------------------------------------- payments


def clean_payments(raw: DataFrame) -> DataFrame:
    cbu = text.stripped_or_null(F.col("CbuCvu"), " " + text.NBSP)
    return computed_once(
        raw,
        [
            numbers.try_integer(F.col("IdDePago"), "bigint").alias("idDePago"),
            dates.parse_date(F.col("FechaTxt")).alias("fechaPago"),
            cbu.alias("cbu"),
            numbers.payment_amount(F.col("ValorTxt")).alias("monto"),
        ],
        _raw_row(raw),
    )


def payment_rules() -> dict[str, Column]:
    return {
        "id": _known("idDePago"),
        "fecha": _known("fechaPago"),
        "monto": _known("monto"),
        "cuenta": _known("cbu"),
    }


def import_payments(raw: DataFrame, units: DataFrame, payments: DataFrame) -> PaymentImport:
    """New payments tied to the unit that holds their account now; known ids are skipped.

    An account of several units goes to the lowest one and is reported.
    """
    good, bad = quality.split_valid(clean_payments(raw), payment_rules())
    kept, rest = dedup.split_repeated(good, ["idDePago"], carried=[RAW_ROW])
    fresh = upsert.new_rows(payments, materialize(_typed(kept)), ["idDePago"])
    owners = joins.account_owner(units)
    linked = fresh.join(owners, "cbu", "left").withColumnRenamed("idUF", "nroUnidadFuncional")
    return PaymentImport(
        upsert.shaped_like(payments, linked),
        owners.filter("unidades > 1"),
        _invalid(bad).unionByName(_repeated(rest, F.col("copias"))),
    )


# ------------------------------------------------------------------------------------ groups


def clean_groups(raw: DataFrame) -> DataFrame:
    _, name, address, count, area = raw.columns
    return computed_once(
        raw,
        [
            text.truncate(text.trimmed(F.col(f"`{name}`")), 100).alias("nombre"),
            text.truncate(text.trimmed(F.col(f"`{address}`")), 100).alias("domicilio"),
            numbers.grouped_integer(F.col(f"`{count}`")).alias("cantidadUnidades"),
            numbers.grouped_integer(F.col(f"`{area}`")).alias("m2totales"),
        ],
        _raw_row(raw),
    )


def group_rules() -> dict[str, Column]:
    return {
        "nombre": F.col("nombre") != "",
        "domicilio": F.col("domicilio") != "",
        "unidades": F.col("cantidadUnidades") > 0,
        "m2": F.col("m2totales") > 0,
    }


def import_groups(raw: DataFrame, groups: DataFrame, reference_order: bool = False) -> TableImport:
    """Upsert by name. Rows are checked before one per name is kept.

    With `reference_order` one row per name is kept first, so that a name whose kept row is
    invalid is lost even when another of its rows is valid.
    """
    rows = clean_groups(raw)
    if reference_order:
        rows, rest = dedup.split_repeated(rows, ["nombre"], fold=["nombre"])
    good, bad = quality.split_valid(rows, group_rules())
    if not reference_order:
        good, rest = dedup.split_repeated(good, ["nombre"], fold=["nombre"], carried=[RAW_ROW])
    source = materialize(_typed(good))
    rejects = _invalid(bad).unionByName(_repeated(rest, F.col("copias")))
    updated = upsert.update_matched(
        groups, source, ["nombre"], columns=["domicilio", "cantidadUnidades", "m2totales"], fold=["nombre"]
    )
    fresh = upsert.new_rows(groups, source, ["nombre"], fold=["nombre"])
    inserted = upsert.shaped_like(groups, identity.number_rows(fresh, groups, "id", ["nombre"]))
    return TableImport(updated.unionByName(inserted), inserted, rejects)


# --------------------------------------------------------------------------------- providers


def import_providers(raw: DataFrame, groups: DataFrame, providers: DataFrame) -> TableImport:
    """Upsert of the account by (group, name, service type); a missing account overwrites."""
    named = joins.group_by_name(raw, text.trimmed(F.col("F4")), groups, "left")
    typed = computed_once(
        named,
        [
            F.col("idConsorcio"),
            text.truncate(text.trimmed(F.col("F1")), 100).alias("tipoServicio"),
            text.truncate(text.trimmed(F.col("F2")), 100).alias("nombre"),
            numbers.account_number(F.col("F3")).alias("cuenta"),
        ],
        _raw_row(raw),
    )
    good, bad = quality.split_valid(
        typed,
        {
            "tipo": F.col("tipoServicio") != "",
            "nombre": F.col("nombre") != "",
            UNKNOWN_GROUP: _known("idConsorcio"),
        },
    )
    key, fold = ["idConsorcio", "nombre", "tipoServicio"], ["nombre", "tipoServicio"]
    kept, rest = dedup.split_repeated(good, key, fold=fold, carried=[RAW_ROW])
    source = materialize(_typed(kept))
    updated = upsert.update_matched(providers, source, key, columns=["cuenta"], fold=fold)
    fresh = upsert.new_rows(providers, source, key, fold=fold)
    inserted = upsert.shaped_like(providers, identity.number_rows(fresh, providers, "id", key))
    rejects = _invalid(bad).unionByName(_repeated(rest, F.col("copias")))
    return TableImport(updated.unionByName(inserted), inserted, rejects)


# ----------------------------------------------------------------------------- unit accounts


def clean_unit_accounts(raw: DataFrame) -> DataFrame:
    bare = text.strip_chars(F.col("cbu_uf"), '" .-' + text.NBSP)
    apartment = text.truncate(text.strip_chars(F.col("departamento"), '"'), 10)
    return computed_once(
        raw,
        [
            text.stripped_or_null(F.col("nombreConsorcio"), '"').alias("consorcio"),
            numbers.try_integer(text.strip_chars(F.col("nroUF"), '" .-'), "bigint").alias("numeroUnidad"),
            F.nullif(apartment, F.lit("")).alias("departamento"),
            F.nullif(text.truncate(bare, 30), F.lit("")).alias("cbu_cvu_actual"),
        ],
        _raw_row(raw),
    )


def _digits_or_null(column: str) -> Column:
    return F.coalesce(text.digits_only(F.col(column)), F.lit(True))


def _changed_units(units: DataFrame, source: DataFrame) -> DataFrame:
    """Units the change set touched, as the linking job takes them."""
    touched = source.select("idConsorcio", "numeroUnidad")
    return units.join(touched, ["idConsorcio", "numeroUnidad"], "left_semi").select(
        "idUF", "cbu_cvu_actual"
    )


def _upsert_units(
    units: DataFrame, source: DataFrame, columns: list[str], defaults: dict[str, Column]
) -> DataFrame:
    key = ["idConsorcio", "numeroUnidad"]
    updated = upsert.update_matched(units, source, key, policy=upsert.COALESCE, columns=columns)
    fresh = upsert.new_rows(units, source, key)
    numbered = identity.number_rows(fresh, units, "idUF", key)
    return updated.unionByName(upsert.shaped_like(units, numbered, defaults))


def import_unit_accounts(raw: DataFrame, groups: DataFrame, units: DataFrame) -> UnitAccountImport:
    """Accounts and apartments of units; a missing value keeps the old one.

    Unknown units are inserted. `changed` goes to the linking job.
    """
    rules = {
        "grupo": _known("consorcio"),
        "unidad": _known("numeroUnidad"),
        "cuenta": _digits_or_null("cbu_cvu_actual"),
    }
    good, bad = quality.split_valid(clean_unit_accounts(raw), rules)
    one, rest = dedup.split_repeated(good, ["consorcio", "numeroUnidad"], fold=["consorcio"])
    named = joins.group_by_name(one, F.col("consorcio"), groups, "left")
    source, lost = quality.split_valid(named, {UNKNOWN_GROUP: _known("idConsorcio")})
    source = materialize(_typed(source))
    state = _upsert_units(
        units,
        source.drop("consorcio"),
        ["departamento", "cbu_cvu_actual"],
        {"coeficiente": F.lit(0), "m2_UF": F.lit(1)},
    )
    rejects = _invalid(bad).unionByName(_invalid(lost)).unionByName(_repeated(rest, F.col("copias")))
    return UnitAccountImport(state, _changed_units(state, source), rejects)


# ----------------------------------------------------------------------------------- persons


def clean_persons(raw: DataFrame) -> DataFrame:
    return computed_once(
        raw,
        [
            text.stripped_or_null(F.col("nombre"), '"').alias("nombre"),
            text.stripped_or_null(F.col("apellido"), '"').alias("apellido"),
            numbers.try_integer(text.strip_chars(F.col("dni"), " .-"), "bigint").alias("dni"),
            text.stripped_or_null(F.col("email"), '" ').alias("email"),
            text.stripped_or_null(F.col("telefono"), '" ').alias("telefono"),
            text.stripped_or_null(F.col("cbu_cvu"), '" ').alias("cbu_cvu"),
            text.tenure_label(F.col("tipotitularidad")).alias("tipoTitularidad"),
        ],
        _raw_row(raw),
    )


def person_rules() -> dict[str, Column]:
    return {
        "dni": F.col("dni").between(10_000_000, 99_999_999),
        "nombre": _known("nombre"),
        "apellido": _known("apellido"),
        "telefono": _digits_or_null("telefono"),
        "cuenta": _digits_or_null("cbu_cvu"),
    }


def import_persons(
    raw: DataFrame, persons: DataFrame, sealed: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> TableImport:
    """Full overwrite by dni; a dni seen twice in the file is dropped entirely.

    `sealed` brings the file's rows to the form of `persons`, such as encrypted columns; rows
    that do not change are carried as they are.
    """
    good, bad = quality.split_valid(clean_persons(raw), person_rules())
    source = materialize(sealed(dedup.drop_repeated(_typed(good), ["dni"])))
    updated = upsert.update_matched(persons, source, ["dni"])
    fresh = upsert.new_rows(persons, source, ["dni"])
    inserted = upsert.shaped_like(persons, identity.number_rows(fresh, persons, "id", ["dni"]))
    rejects = _invalid(bad).unionByName(_repeated(dedup.rows_of_repeated(good, ["dni"])))
    return TableImport(updated.unionByName(inserted), inserted, rejects)


# ------------------------------------------------------------------------------------- units


def clean_units(raw: DataFrame) -> DataFrame:
    """Typed unit rows; a missing coefficient is 0.0, a missing area 1 and missing rooms 0."""
    c = F.col
    return computed_once(
        raw,
        [
            text.trimmed(c("`Nombre del consorcio`")).alias("consorcio"),
            numbers.try_integer(c("nroUnidadFuncional"), "bigint").alias("numeroUnidad"),
            numbers.floor_number(c("Piso")).alias("piso"),
            text.blank_to_null(c("departamento")).alias("departamento"),
            F.coalesce(numbers.try_decimal(c("coeficiente"), "decimal(3,1)"), F.lit(0))
            .cast("decimal(3,1)")
            .alias("coeficiente"),
            F.coalesce(numbers.try_integer(c("m2_unidad_funcional")), F.lit(1)).alias("m2_UF"),
            text.yes_flag(c("bauleras")).alias("baulera"),
            text.yes_flag(c("cochera")).alias("cochera"),
            F.coalesce(numbers.try_integer(c("m2_baulera")), F.lit(0)).alias("m2_baulera"),
            F.coalesce(numbers.try_integer(c("m2_cochera")), F.lit(0)).alias("m2_cochera"),
        ],
        _raw_row(raw),
    )


def unit_rules() -> dict[str, Column]:
    return {
        UNKNOWN_GROUP: _known("idConsorcio"),
        "unidad": _known("numeroUnidad"),
        "m2": F.col("m2_UF") > 0,
        "coeficiente": F.col("coeficiente") >= 0,
        "m2 accesoria": (F.col("m2_baulera") >= 0) & (F.col("m2_cochera") >= 0),
    }


def import_units(
    raw: DataFrame, groups: DataFrame, units: DataFrame, accessories: DataFrame
) -> UnitImport:
    """Units and their extra rooms. Accounts stay as they are; a missing coefficient or area
    resets the stored one. A (group, number) seen twice in the file is rejected."""
    named = joins.group_by_name(clean_units(raw), F.col("consorcio"), groups, "left")
    good, bad = quality.split_valid(named, unit_rules())
    key = ["idConsorcio", "numeroUnidad"]
    source = materialize(dedup.drop_repeated(_typed(good).drop("consorcio"), key))
    state = _upsert_units(units, source, ["piso", "departamento", "coeficiente", "m2_UF"], {})
    rooms = source.join(state.select("idUF", *key), key).select(
        F.col("idUF").alias("idUnidadFuncional"), "cochera", "baulera", "m2_baulera", "m2_cochera"
    )
    return UnitImport(
        state,
        upsert.upsert(accessories, rooms, ["idUnidadFuncional"]),
        _changed_units(state, source),
        _invalid(bad).unionByName(_repeated(dedup.rows_of_repeated(good, key))),
    )
