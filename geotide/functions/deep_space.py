"""The deep-space part of the SGP4 model: what the Sun, the Moon and resonances with the Earth's rotation do to an orbit.

After Hoots and Roehrich (Spacetrack Report 3) and Vallado and others (AIAA
2006-6753), over numpy arrays with one entry an orbit.  Angles are radians,
times minutes, ``n`` radians a minute; ``since_1950`` is the epoch in days
since 1949-12-31 00:00 UT.
"""

from __future__ import annotations

import numpy as np

#: Fixed values of the published model: mean motions and eccentricities of Sun and Moon, Earth's rotation (radians a minute).
_SUN_N, _SUN_E, _MOON_N, _MOON_E = 1.19459e-5, 0.01675, 1.5835218e-4, 0.05490
_SPIN = 4.37526908801129966e-3
#: Resonance strengths and phases.
_Q22, _Q31, _Q33 = 1.7891679e-6, 2.1460748e-6, 2.2123015e-7
_R22, _R32, _R44, _R52, _R54 = 1.7891679e-6, 3.7393792e-7, 7.3636953e-9, 1.1428639e-7, 2.1765803e-9
_DAY_PHASES = (0.13130908, 2.8843198, 0.37448087)
_HALF_DAY_PHASES = (5.7686396, 0.95240898, 1.8014998, 1.0508330, 4.4108898)
#: Half-day eccentricity polynomials in 1, e, e**2, e**3, by range of e.
_POLY = {
    "211": ((3.616, -13.2470, 16.2900, 0.0), (-72.099, 331.819, -508.738, 266.724)),
    "310": ((-19.302, 117.3900, -228.4190, 156.5910), (-346.844, 1582.851, -2415.925, 1246.113)),
    "322": ((-18.9068, 109.7927, -214.6334, 146.5816), (-342.585, 1554.908, -2366.899, 1215.972)),
    "410": ((-41.122, 242.6940, -471.0940, 313.9530), (-1052.797, 4758.686, -7193.992, 3651.957)),
    "422": ((-146.407, 841.8800, -1629.014, 1083.4350), (-3581.690, 16178.110, -24462.770, 12422.520)),
    "520": ((-532.114, 3017.977, -5740.032, 3708.2760), (1464.74, -4664.75, 3763.64, 0.0), (-5149.66, 29936.92, -54087.36, 31324.56)),
    "533": ((-919.22770, 4988.6100, -9064.7700, 5542.21), (-37995.780, 161616.52, -229838.20, 109377.94)),
    "521": ((-822.71072, 4568.6173, -8491.4146, 5337.524), (-51752.104, 218913.95, -309468.16, 146349.42)),
    "532": ((-853.66600, 4690.2500, -8624.7700, 5341.4), (-40023.880, 170470.89, -242699.48, 115605.82)),
}
_STEP = 720.0
_TURN = 2 * np.pi


def sidereal_angle(since_1950: np.ndarray) -> np.ndarray:
    """Greenwich sidereal time at the epoch."""
    c = (since_1950 + 2433281.5 - 2451545.0) / 36525.0
    seconds = -6.2e-6 * c**3 + 0.093104 * c**2 + (876600.0 * 3600 + 8640184.812866) * c + 67310.54841
    return np.mod(np.radians(seconds / 240.0), _TURN)


def _body(cos_g, sin_g, cos_i, sin_i, cos_h, sin_h, strength, o) -> dict[str, np.ndarray]:
    """One perturbing body's geometry relative to the orbit: the s and z terms."""
    a1, a3 = cos_g * cos_h + sin_g * cos_i * sin_h, -sin_g * cos_h + cos_g * cos_i * sin_h
    a7, a8 = -cos_g * sin_h + sin_g * cos_i * cos_h, sin_g * sin_i
    a9, a10 = sin_g * sin_h + cos_g * cos_i * cos_h, cos_g * sin_i
    a2, a4 = o["ci"] * a7 + o["si"] * a8, o["ci"] * a9 + o["si"] * a10
    a5, a6 = -o["si"] * a7 + o["ci"] * a8, -o["si"] * a9 + o["ci"] * a10
    x1, x2 = a1 * o["cw"] + a2 * o["sw"], a3 * o["cw"] + a4 * o["sw"]
    x3, x4 = -a1 * o["sw"] + a2 * o["cw"], -a3 * o["sw"] + a4 * o["cw"]
    x5, x6, x7, x8 = a5 * o["sw"], a6 * o["sw"], a5 * o["cw"], a6 * o["cw"]
    e2, b2 = o["e"] ** 2, 1 - o["e"] ** 2
    z31, z32, z33 = 12 * x1**2 - 3 * x3**2, 24 * x1 * x2 - 6 * x3 * x4, 12 * x2**2 - 3 * x4**2
    z = {
        "31": z31, "32": z32, "33": z33,
        "1": 2 * (3 * (a1**2 + a2**2) + z31 * e2) + b2 * z31,
        "2": 2 * (6 * (a1 * a3 + a2 * a4) + z32 * e2) + b2 * z32,
        "3": 2 * (3 * (a3**2 + a4**2) + z33 * e2) + b2 * z33,
        "11": -6 * a1 * a5 + e2 * (-24 * x1 * x7 - 6 * x3 * x5),
        "12": -6 * (a1 * a6 + a3 * a5) + e2 * (-24 * (x2 * x7 + x1 * x8) - 6 * (x3 * x6 + x4 * x5)),
        "13": -6 * a3 * a6 + e2 * (-24 * x2 * x8 - 6 * x4 * x6),
        "21": 6 * a2 * a5 + e2 * (24 * x1 * x5 - 6 * x3 * x7),
        "22": 6 * (a4 * a5 + a2 * a6) + e2 * (24 * (x2 * x5 + x1 * x6) - 6 * (x4 * x7 + x3 * x8)),
        "23": 6 * a4 * a6 + e2 * (24 * x2 * x6 - 6 * x4 * x8),
    }
    s3 = strength / o["n"]
    s4 = s3 * np.sqrt(b2)
    s = {"s1": -15 * o["e"] * s4, "s2": -0.5 * s3 / np.sqrt(b2), "s3": s3, "s4": s4, "s5": x1 * x3 + x2 * x4, "s6": x2 * x3 + x1 * x4, "s7": x2 * x4 - x1 * x3}
    return {**z, **s}


def _periodic(b: dict, ecc: float, e2: np.ndarray) -> dict[str, tuple]:
    """Coefficients of a body's periodic terms: of the two double-angle functions and of the sine."""
    s1, s2, s3, s4 = b["s1"], b["s2"], b["s3"], b["s4"]
    zero = np.zeros_like(s1)
    return {
        "e": (2 * s1 * b["s6"], 2 * s1 * b["s7"], zero),
        "i": (2 * s2 * b["12"], 2 * s2 * (b["13"] - b["11"]), zero),
        "l": (-2 * s3 * b["2"], -2 * s3 * (b["3"] - b["1"]), -2 * s3 * (-21 - 9 * e2) * ecc),
        "gh": (2 * s4 * b["32"], 2 * s4 * (b["33"] - b["31"]), -18 * s4 * ecc),
        "h": (-2 * s2 * b["22"], -2 * s2 * (b["23"] - b["21"]), zero),
    }


def _secular(b: dict, rate: float, e2: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, ...]:
    """A body's rates of e, i, mean anomaly, gh and h; the last is left out near the equator."""
    h = np.where(flat, 0.0, -rate * b["s2"] * (b["21"] + b["23"]))
    return b["s1"] * rate * b["s5"], b["s2"] * rate * (b["11"] + b["13"]), -rate * b["s3"] * (b["1"] + b["3"] - 14 - 6 * e2), b["s4"] * rate * (b["31"] + b["33"] - 6), h


class DeepSpace:
    """Sun, Moon and resonance terms of orbits at their epochs."""

    def __init__(self, n, e, incl, node, argp, mean, since_1950, m_dot, w_dot, node_dot, xke):
        self.n0, self.w0, self.w_dot = n, argp, w_dot
        o = {"n": n, "e": e, "ci": np.cos(incl), "si": np.sin(incl), "cw": np.cos(argp), "sw": np.sin(argp)}
        e2, cos_node, sin_node = e**2, np.cos(node), np.sin(node)
        day = since_1950 + 18261.5
        asc = np.mod(4.5236020 - 9.2422029e-4 * day, _TURN)  # the Moon's ascending node
        sin_a, cos_a = np.sin(asc), np.cos(asc)
        cos_il = 0.91375164 - 0.03568096 * cos_a
        sin_il = np.sqrt(1 - cos_il**2)
        sin_hl = 0.089683511 * sin_a / sin_il
        cos_hl = np.sqrt(1 - sin_hl**2)
        gam = 5.8351514 + 0.0019443680 * day
        gl = gam + np.arctan2(0.39785416 * sin_a / sin_il, cos_hl * cos_a + 0.91744867 * sin_hl * sin_a) - asc
        sun = _body(0.1945905, -0.98088458, 0.91744867, 0.39785416, cos_node, sin_node, 2.9864797e-6, o)
        moon = _body(np.cos(gl), np.sin(gl), cos_il, sin_il, cos_hl * cos_node + sin_hl * sin_node, sin_node * cos_hl - cos_node * sin_hl, 4.7968065e-7, o)
        self.sun, self.moon = _periodic(sun, _SUN_E, e2), _periodic(moon, _MOON_E, e2)
        self.sun_phase, self.moon_phase = np.mod(6.2565837 + 0.017201977 * day, _TURN), np.mod(4.7199672 + 0.22997150 * day - gam, _TURN)
        flat = (incl < 5.2359877e-2) | (incl > np.pi - 5.2359877e-2)
        s, m = _secular(sun, _SUN_N, e2, flat), _secular(moon, _MOON_N, e2, flat)
        self.e_dot, self.i_dot, self.m_dot = s[0] + m[0], s[1] + m[1], s[2] + m[2]
        over = np.where(o["si"] != 0, o["si"], 1)
        self.node_dot = (s[4] + m[4]) / over
        self.w_dot_ls = s[3] + m[3] - o["ci"] * self.node_dot
        self._resonances(o, e2, incl, node, argp, mean, since_1950, m_dot, w_dot, node_dot, xke)

    def _resonances(self, o, e2, incl, node, argp, mean, since_1950, m_dot, w_dot, node_dot, xke):
        n, e, ci, si = o["n"], o["e"], o["ci"], o["si"]
        self.daily = (n > 0.0034906585) & (n < 0.0052359877)
        self.half = (n >= 8.26e-3) & (n <= 9.24e-3) & (e >= 0.5)
        self.theta0 = sidereal_angle(since_1950)
        inv = (n / xke) ** (2 / 3)
        # one revolution a day
        f220, f330 = 0.75 * (1 + ci) ** 2, 1.875 * (1 + ci) ** 3
        f311 = 0.9375 * si**2 * (1 + 3 * ci) - 0.75 * (1 + ci)
        base = 3 * n**2 * inv**2
        self.day = (
            base * f311 * (1 + 2 * e2) * _Q31 * inv,
            2 * base * f220 * (1 + e2 * (-2.5 + 0.8125 * e2)) * _Q22,
            3 * base * f330 * (1 + e2 * (-6 + 6.60937 * e2)) * _Q33 * inv,
        )
        # two revolutions a day
        power = np.stack([np.ones_like(e), e, e2, e * e2])
        g = {}
        for k, poly in _POLY.items():
            values = [np.tensordot(p, power, 1) for p in poly]
            edge = 0.7 if k in ("533", "521", "532") else 0.65
            low = e < edge if edge == 0.7 else e <= edge
            high = np.where(e > 0.715, values[2], values[1]) if len(values) == 3 else values[1]
            g[k] = np.where(low, values[0], high)
        g["201"] = -0.306 - (e - 0.64) * 0.440
        c2, s2 = ci**2, si**2
        f220 = 0.75 * (1 + 2 * ci + c2)
        f522 = 9.84375 * si * (s2 * (1 - 2 * ci - 5 * c2) + 0.33333333 * (-2 + 4 * ci + 6 * c2))
        f523 = si * (4.92187512 * s2 * (-2 - 4 * ci + 10 * c2) + 6.56250012 * (1 + 2 * ci - 3 * c2))
        f542 = 29.53125 * si * (2 - 8 * ci + c2 * (-12 + 8 * ci + 10 * c2))
        f543 = 29.53125 * si * (-2 - 8 * ci + c2 * (12 + 8 * ci - 10 * c2))
        p22, p32, p44, p52, p54 = _HALF_DAY_PHASES
        # (strength, multiple of the argument of perigee, multiple of the longitude, phase)
        self.half_day = [
            (base * _R22 * f220 * g["201"], 2, 1, p22), (base * _R22 * 1.5 * s2 * g["211"], 0, 1, p22),
            (base * inv * _R32 * 1.875 * si * (1 - 2 * ci - 3 * c2) * g["310"], 1, 1, p32),
            (base * inv * _R32 * -1.875 * si * (1 + 2 * ci - 3 * c2) * g["322"], -1, 1, p32),
            (2 * base * inv**2 * _R44 * 35 * s2 * f220 * g["410"], 2, 2, p44), (2 * base * inv**2 * _R44 * 39.3750 * s2**2 * g["422"], 0, 2, p44),
            (base * inv**3 * _R52 * f522 * g["520"], 1, 1, p52), (base * inv**3 * _R52 * f523 * g["532"], -1, 1, p52),
            (2 * base * inv**3 * _R54 * f542 * g["521"], 1, 2, p54), (2 * base * inv**3 * _R54 * f543 * g["533"], -1, 2, p54),
        ]
        daily_start = mean + node + argp - self.theta0
        self.start = np.mod(np.where(self.half, mean + 2 * node - 2 * self.theta0, daily_start), _TURN)
        daily_drift = m_dot + w_dot + node_dot - _SPIN + self.m_dot + self.w_dot_ls + self.node_dot - n
        self.drift = np.where(self.half, m_dot + self.m_dot + 2 * (node_dot + self.node_dot - _SPIN) - n, daily_drift)

    def _pull(self, lon: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Change of the mean motion at a resonance longitude, and its derivative by that longitude."""
        force, slope = np.zeros_like(lon), np.zeros_like(lon)
        for k, (strength, phase) in enumerate(zip(self.day, _DAY_PHASES, strict=True), 1):
            force += np.where(self.daily, strength * np.sin(k * (lon - phase)), 0)
            slope += np.where(self.daily, k * strength * np.cos(k * (lon - phase)), 0)
        w = self.w0 + self.w_dot * at
        for strength, of_w, of_lon, phase in self.half_day:
            angle = of_w * w + of_lon * lon - phase
            force += np.where(self.half, strength * np.sin(angle), 0)
            slope += np.where(self.half, of_lon * strength * np.cos(angle), 0)
        return force, slope

    def secular(self, t, e, incl, argp, node, mean):
        """(n, e, incl, argp, node, mean) with secular and resonance effects at ``t``."""
        e, incl, argp, node, mean = e + self.e_dot * t, incl + self.i_dot * t, argp + self.w_dot_ls * t, node + self.node_dot * t, mean + self.m_dot * t
        n, any_ = self.n0.copy(), self.daily | self.half
        if any_.any():
            at, rate, lon, step = np.zeros_like(t), self.n0.copy(), self.start.copy(), np.where(t > 0, _STEP, -_STEP)
            while True:
                force, slope = self._pull(lon, at)
                lon_dot = rate + self.drift
                slope = slope * lon_dot
                go = any_ & (np.abs(t - at) >= _STEP)
                if not go.any():
                    break
                lon = np.where(go, lon + lon_dot * step + force * _STEP**2 / 2, lon)
                rate = np.where(go, rate + force * step + slope * _STEP**2 / 2, rate)
                at = np.where(go, at + step, at)
            rest = t - at
            now = rate + force * rest + slope * rest**2 * 0.5
            lon = lon + lon_dot * rest + force * rest**2 * 0.5
            theta = np.mod(self.theta0 + t * _SPIN, _TURN)
            mean = np.where(self.half, lon - 2 * node + 2 * theta, np.where(self.daily, lon - node - argp + theta, mean))
            n = np.where(any_, now, n)
        return n, e, incl, argp, node, mean

    def periodics(self, t, e, incl, argp, node, mean):
        """(e, incl, argp, node, mean) with the Sun's and the Moon's periodic effects at ``t``."""
        total = dict.fromkeys(self.sun, 0.0)
        for terms, phase, rate, ecc in ((self.sun, self.sun_phase, _SUN_N, _SUN_E), (self.moon, self.moon_phase, _MOON_N, _MOON_E)):
            zm = phase + rate * t
            zf = zm + 2 * ecc * np.sin(zm)
            f2, f3 = 0.5 * np.sin(zf) ** 2 - 0.25, -0.5 * np.sin(zf) * np.cos(zf)
            for k, (a, b, c) in terms.items():
                total[k] = total[k] + a * f2 + b * f3 + c * np.sin(zf)
        d_i, d_l, d_gh, d_h = total["i"], total["l"], total["gh"], total["h"]
        incl, e = incl + d_i, e + total["e"]
        si, ci = np.sin(incl), np.cos(incl)
        # away from the equator the angles themselves, near it the node's direction
        h = d_h / np.where(si != 0, si, 1)
        x, y = si * np.sin(node), si * np.cos(node)
        x, y = x + d_h * np.cos(node) + d_i * ci * np.sin(node), y - d_h * np.sin(node) + d_i * ci * np.cos(node)
        old = np.mod(node, _TURN)
        long_ = mean + argp + ci * old + d_l + d_gh - d_i * old * si
        new = np.arctan2(x, y)
        new = np.where(np.abs(old - new) > np.pi, np.where(new < old, new + _TURN, new - _TURN), new)
        far = incl >= 0.2
        return e, incl, np.where(far, argp + d_gh - ci * h, long_ - mean - d_l - ci * new), np.where(far, node + h, new), mean + d_l
