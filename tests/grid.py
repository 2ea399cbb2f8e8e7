"""A small landing folder of published-style CSV files with planted edge rows; answers are worked out by hand in the tests."""

from __future__ import annotations

import datetime as dt
import pathlib

from wattfold.config import HEADERS

HOURS = 48
START = dt.datetime(2025, 6, 1)


def _write(folder: pathlib.Path, dataset: str, name: str, rows: list[dict]) -> None:
    path = folder / dataset
    path.mkdir(parents=True, exist_ok=True)
    quote = lambda v: '"' + v.replace('"', '""') + '"' if any(c in v for c in ';"\n') else v
    lines = [";".join(HEADERS[dataset])] + [";".join(quote(r.get(c, "")) for c in HEADERS[dataset]) for r in rows]
    (path / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def balance_rows():
    """Four subsystems and their total over 48 hours; NE has negative net load from 10h to 13h."""
    rows = []
    for h in range(HOURS):
        t = (START + dt.timedelta(hours=h)).strftime("%Y-%m-%d %H:%M:%S")
        total = 0
        for i, sub in enumerate(("N", "NE", "SE", "S")):
            load = 100 * (i + 1)
            wind = 250 if sub == "NE" and 10 <= h % 24 <= 13 else 20
            total += load
            rows.append({
                "id_subsistema": sub, "nom_subsistema": f"{sub}   ", "din_instante": t, "val_gerhidraulica": "50", "val_gertermica": "-",
                "val_gereolica": str(wind), "val_gersolar": "0", "val_carga": f"{load}.0", "val_intercambio": str(wind + 50 - load)})
        rows.append({"id_subsistema": "SIN", "nom_subsistema": "SIN", "din_instante": t, "val_gerhidraulica": "200", "val_gereolica": "0",
                     "val_carga": f"{total // 1000},{total % 1000:03d}" if total >= 1000 else str(total), "val_intercambio": "0"})
    rows.append({"id_subsistema": "NE", "din_instante": "2025-02-30 00:00:00", "val_carga": "1"})  # impossible time
    rows.append({**rows[0]})  # exact copy
    zero = {**rows[5], "val_carga": "0"}  # same key, later in the file order of a later file
    return rows, zero


def storage_rows():
    """One day longer than the balance; NE sits on the band edges 30, 50 and 70."""
    levels = {"NE": ("30", "50", "70"), "SE": ("29.99", "N/A", "100"), "N": ("10", "10", "abc"), "S": ("60", "60", "60")}
    return [
        {"id_subsistema": sub, "ear_data": (START + dt.timedelta(days=i)).strftime("%Y-%m-%d"), "ear_max_subsistema": "1000",
         "ear_verif_subsistema_mwmes": "500", "ear_verif_subsistema_percentual": v}
        for sub, vs in levels.items() for i, v in enumerate(vs)]


def _reading(plant, t, gen, ref, why="", origin="", official="", **more):
    return {"id_subsistema": "NE", "nom_subsistema": "NORDESTE  ", "id_estado": "RN", "nom_estado": "RIO GRANDE DO NORTE", "nom_usina": "Conj. A",
            "id_ons": plant, "ceg": "-", "din_instante": t, "val_geracao": gen, "val_disponibilidade": "100", "val_geracaoreferencia": ref,
            "cod_razaorestricao": why, "cod_origemrestricao": origin, "val_geracaonaorealizadaapurada": official, **more}


def wind_rows():
    d = "2025-06-01 "
    text = 'Limite "LT 500 kV"\nAçu; III'
    return [
        _reading("W1", d + "00:00:00", "10", "30", "ENE", "SIS", "20", dsc_restricao=text, num_minutos_ene="30.0"),
        _reading("W1", d + "00:30:00", "10", "20", "CNF", "LOC", "10", dsc_restricao=text),
        _reading("W1", d + "01:00:00", "40", "30", "REL", "SIS", "0", val_geracaoreferenciafinal="30"),  # above reference
        _reading("W1", d + "01:30:00", "10", "30", "", "", "3"),  # gap without a reason, official value without a reason
        _reading("W1", d + "02:00:00", "10", "", "ENE", "SIS", ""),  # reason without reference
        _reading("W1", d + "03:00:00", "10", "12", "PAR", "SIS", "2"),  # one half hour only, rare reason
        _reading("W1", d + "03:00:00", "10", "12", "PAR", "SIS", "2"),  # exact copy
        _reading("W1", "lixo", "10", "12"),
        _reading("W1", "2025-06-02 00:00:00", "-1", "0", "", "", nom_usina="Conj. A novo", id_estado="CE", nom_estado="CEARA"),
        _reading("W2", d + "00:00:00", "106", "200", "NULL", "", ceg="CEG.1", nom_usina="Conj. A"),  # above availability + 5%
    ]


def solar_rows():
    return [_reading("S1", f"2025-06-01 {h:02d}:{m}:00", "5", "10", "ENE" if h == 12 else "", "SIS" if h == 12 else "", "5" if h == 12 else "",
                     ceg="CEG.9", nom_usina="UFV B", nom_pontoconexao="P\n1") for h in (11, 12) for m in ("00", "30")]


def capacity_rows():
    unit = lambda eq, ceg, mw, off="": {"nom_subsistema": "NORDESTE  ", "nom_tipousina": "EOLIELÉTRICA", "nom_usina": "X", "ceg": ceg, "cod_equipamento": f"{eq}   ",
                                        "num_unidadegeradora": "1  ", "dat_entradaoperacao": "2020-01-01", "dat_desativacao": off, "val_potenciaefetiva": mw}
    return [unit("E1", "CEG.1", "10.5"), unit("E2", "CEG.1", "1,000.5"), unit("E3", "CEG.1", "99", "2024-01-01"), unit("E4", "CEG.1", ""), unit("E5", "-", "7")]


def land(folder: pathlib.Path) -> str:
    rows, zero = balance_rows()
    _write(folder, "balanco_energia_subsistema", "BALANCO_2025.csv", rows)
    _write(folder, "balanco_energia_subsistema", "BALANCO_2026.csv", [zero])
    _write(folder, "balanco_energia_subsistema", "BALANCO_2019.csv", [{"id_subsistema": "N", "din_instante": "2019-01-01 00:00:00"}])
    _write(folder, "ear_diario_subsistema", "EAR_2025.csv", storage_rows())
    _write(folder, "restricao_coff_eolica", "EOLICA_2025_06.csv", wind_rows())
    _write(folder, "restricao_coff_eolica", "EOLICA_2024_12.csv", wind_rows())
    _write(folder, "restricao_coff_fotovoltaica", "SOLAR_2025_06.csv", solar_rows())
    _write(folder, "capacidade_geracao", "CAPACIDADE.csv", capacity_rows())
    return str(folder)
