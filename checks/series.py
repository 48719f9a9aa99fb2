"""Transverse Mercator series (Karney 2011) rendered as SQL text for the DuckDB checks."""

from __future__ import annotations

from math import sqrt

F = 1 / 298.257223563
N = F / (2 - F)
E = sqrt(F * (2 - F))
R = 0.9996 * 6378137.0 / (1 + N) * (1 + N**2 / 4 + N**4 / 64 + N**6 / 256)
LON0 = 123.0

# Published polynomial coefficients in n, lowest power first, per series term (fixed values).
ALPHA = [
    {1: 1 / 2, 2: -2 / 3, 3: 5 / 16, 4: 41 / 180, 5: -127 / 288, 6: 7891 / 37800},
    {2: 13 / 48, 3: -3 / 5, 4: 557 / 1440, 5: 281 / 630, 6: -1983433 / 1935360},
    {3: 61 / 240, 4: -103 / 140, 5: 15061 / 26880, 6: 167603 / 181440},
    {4: 49561 / 161280, 5: -179 / 168, 6: 6601661 / 7257600},
    {5: 34729 / 80640, 6: -3418889 / 1995840},
    {6: 212378941 / 319334400},
]
BETA = [
    {1: 1 / 2, 2: -2 / 3, 3: 37 / 96, 4: -1 / 360, 5: -81 / 512, 6: 96199 / 604800},
    {2: 1 / 48, 3: 1 / 15, 4: -437 / 1440, 5: 46 / 105, 6: -1118711 / 3870720},
    {3: 17 / 480, 4: -37 / 840, 5: -209 / 4480, 6: 5569 / 90720},
    {4: 4397 / 161280, 5: -11 / 504, 6: -830251 / 7257600},
    {5: 4583 / 161280, 6: -108847 / 3991680},
    {6: 20648693 / 638668800},
]


def _num(value: float) -> str:
    return f"({value!r}::double)"


def _sum(table, along: str, across: str) -> str:
    terms = []
    for j, powers in enumerate(table, start=1):
        coefficient = sum(c * N**k for k, c in powers.items())
        x, y = f"{2 * j}e0*xi_", f"{2 * j}e0*eta_"
        hyper = f"cosh({y})" if across == "cosh" else f"sinh({y})"
        terms.append(f"{_num(coefficient)}*{along}({x})*{hyper}")
    return "(" + "+".join(terms) + ")"


def forward_angles(lat: str, lon: str) -> str:
    s = f"sin(radians({lat}))"
    d = f"radians({lon}-{_num(LON0)})"
    return f"sinh(atanh({s})-{_num(E)}*atanh({_num(E)}*{s})) as t_, sin({d}) as sl_, cos({d}) as cl_"


def forward_x() -> str:
    return f"500000e0+{_num(R)}*(eta_+{_sum(ALPHA, 'cos', 'sinh')})"


def forward_y() -> str:
    return f"{_num(R)}*(xi_+{_sum(ALPHA, 'sin', 'cosh')})"


def inverse_angles(x: str, y: str) -> str:
    return f"{y}/{_num(R)} as xi_, ({x}-500000e0)/{_num(R)} as eta_"


def inverse_series() -> str:
    return f"xi_-{_sum(BETA, 'sin', 'cosh')} as u_, eta_-{_sum(BETA, 'cos', 'sinh')} as v_"


def inverse_target() -> str:
    q = "sin(u_)/sqrt(sinh(v_)*sinh(v_)+cos(u_)*cos(u_))"
    return f"{q} as tp_, {q} as t_"


def newton(source: str, name: str) -> str:
    square = _num(1 - E * E)
    return (
        f"{name} as (select * exclude (t_, q_, s_, w_), t_+(tp_-w_)/sqrt(1+w_*w_)*(1+{square}*t_*t_)/({square}*q_) as t_ from "
        f"(select *, t_*sqrt(1+s_*s_)-s_*q_ as w_ from (select *, sinh({_num(E)}*atanh({_num(E)}*t_/q_)) as s_ from "
        f"(select *, sqrt(1+t_*t_) as q_ from {source}))))"
    )


def inverse_longitude() -> str:
    return f"{_num(LON0)}+degrees(atan2(sinh(v_),cos(u_)))"
