"""Configuration of an edition: which questions form batteries, which are filtered, what is counted."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from ..operators.batteries import Battery, FilteredQuestion
from ..operators.derive import YES_NO, YES_NO_NA

# Concept names of the question batteries.
HOUSEHOLD = ("hh_partn", "hh_child", "hh_par", "hh_sib", "hh_fam", "hh_frnd", "hh_oth")
MEMBERSHIP = ("mem_sport", "mem_hobby", "mem_arts", "mem_soclt", "mem_union", "mem_nbhd", "mem_schl",
              "mem_youth", "mem_snr", "mem_welf", "mem_env", "mem_polp", "mem_oth")
SPORTS = ("spt_walk", "spt_cycl", "spt_run", "spt_fit", "spt_swim", "spt_ftbl", "spt_vball", "spt_bball",
          "spt_tenn", "spt_padl", "spt_yoga", "spt_mart", "spt_danc", "spt_gymn", "spt_oth")
DEVICES = ("dev_comp", "dev_tabl", "dev_spho", "dev_gsm", "dev_stv", "dev_tv", "dev_rad")
SUBSCRIPTIONS = ("sub_dtv", "sub_svid", "sub_smuz", "sub_news", "sub_mag")
POLITICAL = ("pa_pet", "pa_socm", "pa_demo", "pa_mtng", "pa_info", "pa_cont", "pa_press", "pa_civmv",
             "pa_advis", "pa_polp", "pa_oth")
CONNECTION = ("netc_fixed", "netc_mob")
INTERNET = ("net_comm", "net_telew", "net_info", "net_govt", "net_bank", "net_shop", "net_sell", "net_game",
            "net_media", "net_learn", "net_news", "net_socm", "net_publ", "net_route")
CULTURE = ("cult_conc", "cult_cine", "cult_opra", "cult_danc", "cult_thtr", "cult_crcs", "cult_mscl",
           "cult_cbrt", "cult_musm", "cult_mnmt", "cult_lib")

BATTERIES = (
    Battery(HOUSEHOLD, dk="hh_dk", none="hh_alone"),
    Battery(MEMBERSHIP, dk="mem_dk", none="mem_none"),
    Battery(SPORTS, dk="spt_dk"),
    Battery(DEVICES, dk="dev_dk", none="dev_none"),
    Battery(SUBSCRIPTIONS, dk="sub_dk", none="sub_none"),
    Battery(POLITICAL, dk="pa_dk", none="pa_none"),
    Battery(CONNECTION, dk="netc_dk"),
    Battery(INTERNET, dk="net_act_dk"),
)

AT_LEAST_YEARLY = ("yearly", "monthly", "weekly", "daily")
RECENT = ("ltmonth", "monthly", "weekly", "daily")
FILTERS = (
    FilteredQuestion(("sr_illim",), ("sr_chron",), ("yes",)),
    FilteredQuestion(("memboard",), MEMBERSHIP, ("yes",)),
    FilteredQuestion(SPORTS, ("sptfreq",), AT_LEAST_YEARLY),
    FilteredQuestion(("spt_othx",), ("spt_oth",), ("na",), negate=True, na_value=""),
    FilteredQuestion(("icarerel",), ("icarefreq",), AT_LEAST_YEARLY),
    FilteredQuestion(("wb_work",), ("sr_empl",), ("employed",)),
    FilteredQuestion(("wb_schhm",), ("hh_alone",), ("yes",), negate=True),
    FilteredQuestion(CONNECTION, ("nethome",), ("yes",)),
    FilteredQuestion(INTERNET, ("netfreq",), RECENT),
)

# output column -> (counted questions, codes)
COUNTS: dict[str, tuple[tuple[str, ...], Mapping]] = {
    "netntot": (INTERNET, YES_NO_NA),
    "patot": (POLITICAL, YES_NO),
    "memtot": (MEMBERSHIP, YES_NO),
}


@dataclass(frozen=True)
class EditionConfig:
    """What differs between editions, beside their data."""

    surv_id: str
    salt: str
    batteries: tuple[Battery, ...] = BATTERIES
    filters: tuple[FilteredQuestion, ...] = FILTERS
    counts: Mapping[str, tuple[tuple[str, ...], Mapping]] = field(default_factory=lambda: dict(COUNTS))
    culture: tuple[str, ...] = CULTURE
    demographics: tuple[str, ...] = ("sr_sex", "sr_byear", "sr_bmnth")
    covariates: tuple[str, ...] = ("sex", "agecat7", "natltygrp")
    found_covariates: str = r"refnis\d{4}lvl2"  # columns found by name, as the year of the areas differs
    person: str = "pseudo_id"
    response: str = "row_id"
    break_ties: bool = False  # equally good responses of a person: False keeps all, True the one with the smallest key
    cap: float = 5.0
    tol: float = 1e-6
    max_sweeps: int = 500
