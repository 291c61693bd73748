"""Amounts, units, dates and the per-task cleaning rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeloom.functions.arrays import bind
from noticeloom.functions.text import general_value

AMOUNT = "decimal(24,6)"
MONEY = "decimal(20,2)"

# Which labels of a task are amounts, units or dates.
RULES = {
    "amount": [("bid", "中标金额"), ("contract", "金额"), ("tender", "预算")],
    "unit": [("bid", "中标金额单位"), ("contract", "金额单位"), ("tender", "预算单位")],
    "date": [
        ("tender", "报名开始时间"),
        ("tender", "报名结束时间"),
        ("tender", "招标文件领取开始时间"),
        ("tender", "招标文件领取结束时间"),
        ("tender", "开标时间"),
        ("tender", "投标截止时间"),
        ("contract", "开工时间"),
        ("contract", "结束时间"),
    ],
}
COLUMN_RULES = {
    "amount": [("bid", "amount"), ("tender", "budget")],
    "date": [
        ("tender", "sign_up_stime"),
        ("tender", "sign_up_etime"),
        ("tender", "tender_document_stime"),
        ("tender", "tender_document_etime"),
        ("tender", "bid_opening_time"),
        ("tender", "tender_etime"),
    ],
}
PRODUCT_AMOUNTS = ["中标金额", "预算"]
PRODUCT_UNITS = ["中标金额单位", "预算单位"]
DATE_COLUMNS = {
    "bid": ["publish_time", "publish_stime", "publish_etime"],
    "tender": [
        "publish_time",
        "tender_document_stime",
        "tender_document_etime",
        "quote_stime",
        "quote_etime",
        "tender_stime",
        "tender_etime",
        "publish_stime",
        "publish_etime",
        "bid_opening_time",
    ],
    "contract": ["publish_time", "publish_stime", "publish_etime", "start_time", "end_time"],
}


def amount(value: Column) -> Column:
    """First number of a text; 万 multiplies by 10000, a per cent or number-free text gives null."""
    plain = F.replace(value, F.lit(","), F.lit(""))
    number = F.regexp_extract(plain, r"[0-9]+\.[0-9]+|[0-9]+", 0).try_cast(AMOUNT)
    return (
        F.when(F.contains(value, F.lit("万")), F.round(number * 10000, 2))
        .when(F.contains(value, F.lit("%")), F.lit(None))
        .otherwise(number)
        .cast(AMOUNT)
    )


def money(value: Column) -> Column:
    """An amount with 0 in place of none."""
    return F.coalesce(amount(value), F.lit(0)).cast(AMOUNT)


def unit(value: Column) -> Column:
    return F.when(F.contains(value, F.lit("万")), F.lit(10000)).otherwise(F.lit(1))


def clean_date(value: Column, as_of_year: int) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of the digit groups; '' when they make no date, null without digits.

    A first group that is no year gets ``as_of_year`` in front, a two-digit one above 12 gets ``20``.
    """

    def finish(parts: Column) -> Column:
        def at(i: int) -> Column:
            return F.coalesce(F.get(parts, F.lit(i)), F.lit("0")).try_cast("int")

        late = at(3) == 24
        year, month, day = at(0), at(1), at(2)
        hour = F.when(late, F.lit(23)).otherwise(at(3))
        minute = F.when(late, F.lit(59)).otherwise(at(4))
        second = F.when(late, F.lit(59)).otherwise(at(5))
        stamp = F.when(
            year.between(1, 9999) & (second < 60),
            F.try_make_timestamp(year, month, day, hour, minute, second.cast("decimal(16,6)")),
        )
        return F.coalesce(F.date_format(stamp, "yyyy-MM-dd HH:mm:ss"), F.lit(""))

    def complete(groups: Column) -> Column:
        first = F.get(groups, F.lit(0))
        full = (
            F.when(F.length(first) == 4, groups)
            .when(
                (F.length(first) == 2) & (first.try_cast("int") > 12),
                F.transform(groups, lambda g, i: F.when(i == 0, F.concat(F.lit("20"), g)).otherwise(g)),
            )
            .otherwise(F.concat(F.array(F.lit(str(as_of_year))), groups))
        )
        return F.when(F.size(groups) > 0, bind(full, finish))

    return bind(F.regexp_extract_all(value, F.lit(r"[0-9]+"), 0), complete)


def _listed(task: Column | str, name: Column, pairs: list[tuple[str, str]]) -> Column | None:
    """Whether (task, name) is listed; with a fixed task only its own names are compared."""
    if isinstance(task, str):
        own = [n for t, n in pairs if t == task]
        return name.isin(own) if own else None
    return F.concat_ws("|", task, name).isin([f"{t}|{n}" for t, n in pairs])


def clean_value(task: Column | str, label: Column, value: Column, as_of_year: int, rules: dict = RULES) -> Column:
    """General cleaning, then the rule listed for (task, label), as text."""

    def amount_text(plain: Column) -> Column:
        return F.regexp_replace(money(plain).cast("string"), r"\.?0+$", "")

    cleaners = {
        "date": lambda plain: clean_date(plain, as_of_year),
        "unit": lambda plain: unit(plain).cast("string"),
        "amount": amount_text,
    }

    def by_rule(plain: Column) -> Column:
        result = plain
        for kind, clean in cleaners.items():
            listed = _listed(task, label, rules.get(kind, []))
            if listed is not None:
                result = F.when(listed, clean(plain)).otherwise(result)
        return result

    return bind(general_value(value), by_rule)


def amount_fallback(source_money: Column, extracted: Column) -> Column:
    """Cleaned source money, or the extracted amount where the source has none."""
    return F.when(F.coalesce(source_money, F.lit(0)) == 0, extracted).otherwise(source_money)


def parse_times(df, columns: list[str]):
    """Listed columns to timestamps where they exist; what does not parse becomes null."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.expr(f"try_to_timestamp(cast(`{c}` AS string))") for c in present})
