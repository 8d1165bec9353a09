"""Customer queue: newly registered customers, cleaned, with a dense queue id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctmart.functions.clean import (
    STRICT,
    all_but_last_two,
    area_code,
    bad_date,
    bad_number,
    check_digits,
    date_prefix,
    last_two,
    local_number,
    parse_date,
    parse_date_prefix,
    tax_id_root,
    truncate_columns,
)
from acctmart.operators.filters import since_days
from acctmart.operators.groups import top_two
from acctmart.operators.joins import splittable_join
from acctmart.operators.positions import assign_dense_ids
from acctmart.schemas import CUSTOMER_QUEUE, publish
from acctmart.sinks import only_new
from acctmart.sources.extracts import CUSTOMER_QUEUE_EXTRACTS, TableMap

# Days looked back, and the widths of the target's text columns.
LOOK_BACK_DAYS = 2
TEXT_WIDTHS = {"bairro": 50, "cidade": 30, "logradouro": 80}


def recent_registrations(
    registrations: DataFrame, as_of: date | None, mode: str = STRICT, days: int = LOOK_BACK_DAYS
) -> DataFrame:
    """Registrations of the last days, with the day parsed next to its text.

    A registration without a date ends the job in strict mode, as one with a bad date does.
    """
    text = F.col("dtainclusao")
    day = parse_date_prefix(text, mode)
    if mode == STRICT:
        day = F.when(text.isNull(), F.raise_error(F.lit("registration without a date"))).otherwise(day)
    return registrations.withColumn("_day", day).where(since_days(F.col("_day"), as_of, days))


def new_customers(
    extracts: Mapping[str, DataFrame],
    as_of: date | None,
    mode: str = STRICT,
) -> DataFrame:
    """Recently registered customers that have a phone row, before cleaning.

    The recency filter comes first, and only phones of accounts that pass it are ranked.
    Adaptive execution broadcasts the recent registrations where their bytes are few, and
    splits an account with very many of them otherwise. Equal rows are removed on the
    uncleaned values: two registrations on one day both stay.
    """
    key = ["id_conta"]
    recent = recent_registrations(extracts["registrations"], as_of, mode).distinct()
    phones = splittable_join(extracts["phones"], recent.select(*key).distinct(), key, "left_semi")
    top = top_two(phones, "id_conta", "fone_celular", "fone_celular_1", "fone_celular_2")
    registered = splittable_join(extracts["customers"], recent, key)
    return splittable_join(registered, top, key, lane=1).distinct()


def clean_customers(customers: DataFrame, mode: str = STRICT) -> DataFrame:
    """Dates, tax id, texts and phones in the target's form.

    The registration text stays as ``_registered``, to order by.
    """
    cleaned = customers.withColumns(
        {
            "_registered": F.col("dtainclusao"),
            "dtainclusao": F.col("_day"),
            "dtanascfund": parse_date(F.col("dtanascfund"), mode),
            "digcgccpf": check_digits(F.col("cpf_cnpj"), mode),
            "nrocgccpf": tax_id_root(F.col("cpf_cnpj"), mode),
            "foneddd1": area_code(F.col("fone_celular_1")),
            "fonenro1": local_number(F.col("fone_celular_1")),
            "foneddd2": area_code(F.col("fone_celular_2")),
            "fonenro2": local_number(F.col("fone_celular_2")),
        }
    )
    return truncate_columns(cleaned, TEXT_WIDTHS).drop("_day", "fone_celular_1", "fone_celular_2")


def rejected_registrations(registrations: DataFrame) -> DataFrame:
    """Registrations whose text is missing or has no date; lenient mode does not queue them."""
    text = F.col("dtainclusao")
    return registrations.where(text.isNull() | bad_date(date_prefix(text)))


def rejected_values(customers: DataFrame) -> DataFrame:
    """Uncleaned customers with a value that lenient mode turns into null.

    ``rejected`` lists the target columns concerned.
    """
    tax_id = F.col("cpf_cnpj")
    bad = {
        "dtanascfund": bad_date(F.col("dtanascfund")),
        "digcgccpf": bad_number(last_two(tax_id)),
        "nrocgccpf": bad_number(all_but_last_two(tax_id)),
    }
    names = [F.when(condition, F.lit(name)) for name, condition in bad.items()]
    listed = customers.withColumn("rejected", F.array_compact(F.array(*names)))
    return listed.where(F.size("rejected") > 0)


def customer_queue(
    extracts: Mapping[str, DataFrame],
    as_of: date | None,
    start_id: int,
    mode: str = STRICT,
    already_queued: DataFrame | None = None,
    keys: Sequence[str] = ("cpf_cnpj", "dtainclusao"),
) -> DataFrame:
    """The 30-column queue; ids run from ``start_id`` by account and registration text.

    The look-back lets consecutive runs queue a customer again. Given the rows already
    queued, those whose ``keys`` are among them are left out before ids are given. Of the
    queued rows only those with a day in the look-back are read, if the day is a key: no
    other can match.
    """
    cleaned = clean_customers(new_customers(extracts, as_of, mode), mode)
    if already_queued is not None:
        if "dtainclusao" in keys:
            in_reach = since_days(F.col("dtainclusao"), as_of, LOOK_BACK_DAYS)
            already_queued = already_queued.where(in_reach)
        cleaned = only_new(cleaned, already_queued, keys)
    order = [F.asc("id_conta"), F.asc("_registered")]
    return publish(assign_dense_ids(cleaned, order, start_id, "id_pessoa_fila"), CUSTOMER_QUEUE)


def customer_queue_from_tables(
    tables: TableMap, as_of: date | None, start_id: int, mode: str = STRICT
) -> DataFrame:
    return customer_queue(CUSTOMER_QUEUE_EXTRACTS.run(tables, as_of), as_of, start_id, mode)
