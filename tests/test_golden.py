"""
§5), checked on our own outputs at sf0.01 with plain Python arithmetic."""

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from letrado.queries import QUERIES

SF = "/root/testdata/sf0.01"


def r2(x: float) -> float:
    return float(Decimal(repr(x)).quantize(Decimal("0.000000000001"), ROUND_HALF_UP)
                 .quantize(Decimal("0.01"), ROUND_HALF_UP))


@pytest.fixture(scope="module")
def evol(spark):
    return [r.asDict() for r in QUERIES["evolucao_uf_export"](spark, SF).collect()]


@pytest.fixture(scope="module")
def painel(spark):
    return [r.asDict() for r in QUERIES["painel_export"](spark, SF).collect()]


def test_yoy_is_the_rounded_difference_of_rounded_means(evol):
    by = defaultdict(list)
    for r in evol:
        by[r["id_uf"]].append(r)
    bad = 0
    for rows in by.values():
        rows.sort(key=lambda r: r["ano"])
        prev = None
        for r in rows:
            want = 0.0 if prev is None else r2(r["indicador_medio"] - prev)
            bad += r["variacao_yoy"] != want
            prev = r["indicador_medio"]
    assert bad == 0


def test_pct_is_rounded_share(evol):
    assert all(r["pct_municipios_meta_atingida"] == r2(r["municipios_meta_atingida"] / r["total_municipios"] * 100)
               for r in evol)


def test_states_roll_up_to_the_national_panel(evol, painel):
    agg = defaultdict(lambda: [0, 0, 0, 0.0])
    for r in evol:
        a = agg[r["ano"]]
        a[0] += r["total_municipios"]
        a[1] += r["municipios_meta_atingida"]
        a[2] += r["matriculas_total"]
        a[3] += r["indicador_medio"] * r["total_municipios"]
    for p in painel:
        a = agg[p["ano"]]
        assert (a[0], a[1], a[2]) == (p["total_municipios"], p["municipios_meta_atingida"], p["total_matriculas"])
        # weighted mean of rounded state means is within rounding of the national mean
        assert abs(a[3] / a[0] - p["indicador_medio_nacional"]) <= 0.01


def test_export_gap_is_from_the_rounded_mean(painel):
    assert all(p["gap_meta"] == r2(p["indicador_medio_nacional"] - p["meta_nacional"]) for p in painel)
