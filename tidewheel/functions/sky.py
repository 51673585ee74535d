"""Sky coordinates, time and flux models as column expressions. Angles are in degrees."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The J2000 rotation from equatorial to galactic axes.
GALACTIC = [
    [-0.0548755604162154, -0.8734370902348850, -0.4838350155487132],
    [0.4941094278755837, -0.4448296299600112, 0.7469822444972189],
    [-0.8676661490190047, -0.1980763734312015, 0.4559837761750669],
]
#: Published flux models log10 S[Jy] = a + b x + c x^2, x = log10(GHz / ref), for the first of January of a year.
FLUX = {
    "TauA": {
        "weiland_combined": {"ref": 40.0, "a": 2.506, "b": -0.302, "c": 0.0, "year": 2005},
        "weiland_wmaponly": {"ref": 40.0, "a": 2.502, "b": -0.350, "c": 0.0, "year": 2005},
        "hafez": {"ref": 33.0, "a": math.log10(332.8), "b": -0.32, "c": 0.0, "year": 2001},
        "baars": {"ref": 0.001, "a": 3.915, "b": -0.299, "c": 0.0, "year": 1970},
    },
    "CasA": {
        "weiland_combined": {"ref": 40.0, "a": 2.204, "b": -0.682, "c": 0.038, "year": 2000},
        "weiland_wmaponly": {"ref": 40.0, "a": 2.204, "b": -0.712, "c": 0.0, "year": 2000},
        "hafez": {"ref": 33.0, "a": math.log10(182.0), "b": -0.69, "c": 0.0, "year": 2000},
        "baars": {"ref": 0.001, "a": 5.880, "b": -0.792, "c": 0.0, "year": 1965},
    },
    "CygA": {"weiland_combined": {"ref": 40.0, "a": 1.480, "b": -1.172, "c": 0.0, "year": 2000}},
}
#: Fading a year as a share, constant and per log10 GHz.
FADING = {
    "TauA": {"weiland": (0.0021, 0.0), "hafez": (0.0022, 0.0), "trotter": (0.001, 0.0)},
    "CasA": {"weiland": (0.0051, 0.0), "hafez": (0.00394, 0.0), "baars": (0.00394, -0.003)},
    "CygA": {"weiland": (0.0, 0.0)},
}
#: Jupiter's temperatures in K from 34.688 GHz down in steps of 0.5 GHz, and its solid angle in sr at 5.2 au.
JUPITER_KELVIN = [151.013, 150.385, 149.615, 149.876, 148.534, 147.707, 147.235, 146.635, 145.72, 145.347, 144.794, 143.911, 143.225, 142.369, 141.757]
JUPITER_AREA = 2.481e-8
BOLTZMANN, LIGHT = 1.380649e-23, 299792458.0


def _clip(c: Column) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c))


def sexagesimal(text: Column, hours: bool = False) -> Column:
    """``[-]DD:MM:SS`` to degrees; the sign is the text's, so that -0:30 is negative."""
    part = F.split(F.regexp_replace(F.trim(text), r"^[+-]", ""), ":")
    size = part[0].cast("double") + part[1].cast("double") / 60.0 + part[2].cast("double") / 3600.0
    return F.when(F.trim(text).startswith("-"), -1.0).otherwise(1.0) * size * (15.0 if hours else 1.0)


def to_sexagesimal(angle: Column, hours: bool = False) -> Column:
    """Degrees as ``[-]DD:MM:SS.ss``, rounded to hundredths of a second first so that no part reaches 60."""
    cents = F.round(F.abs(angle) / (15.0 if hours else 1.0) * 360000.0).cast("bigint")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    body = F.concat_ws(":", two(F.floor(cents / 360000)), two(F.floor(cents / 6000) % 60), F.concat(two(F.floor(cents / 100) % 60), F.lit("."), two(cents % 100)))
    return F.when(angle < 0, F.concat(F.lit("-"), body)).otherwise(body)


def separation(lon0: Column, lat0: Column, lon1: Column, lat1: Column) -> Column:
    """Great-circle distance by the law of cosines, its argument clipped."""
    a, b = F.radians(lat0), F.radians(lat1)
    return F.degrees(F.acos(_clip(F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(F.radians(lon0 - lon1)))))


def rotate(lon: Column, lat: Column, matrix: list[list[float]]) -> tuple[Column, Column]:
    """Longitude in [0, 360) and latitude after a rotation of the axes."""
    x, y, z = F.cos(F.radians(lat)) * F.cos(F.radians(lon)), F.cos(F.radians(lat)) * F.sin(F.radians(lon)), F.sin(F.radians(lat))
    u, v, w = (row[0] * x + row[1] * y + row[2] * z for row in matrix)
    return F.pmod(F.degrees(F.atan2(v, u)), F.lit(360.0)), F.degrees(F.asin(_clip(w)))


def to_galactic(ra: Column, dec: Column) -> tuple[Column, Column]:
    return rotate(ra, dec, GALACTIC)


def to_equatorial(lon: Column, lat: Column) -> tuple[Column, Column]:
    return rotate(lon, lat, [list(c) for c in zip(*GALACTIC, strict=True)])


def relative(lon: Column, lat: Column, lon0: Column, lat0: Column) -> tuple[Column, Column]:
    """Position in a frame whose origin is (lon0, lat0); longitude in (-180, 180]."""
    d, a, b = F.radians(lon - lon0), F.radians(lat), F.radians(lat0)
    x = F.cos(a) * F.cos(d) * F.cos(b) + F.sin(a) * F.sin(b)
    y, z = F.cos(a) * F.sin(d), F.sin(a) * F.cos(b) - F.cos(a) * F.cos(d) * F.sin(b)
    return F.degrees(F.atan2(y, x)), F.degrees(F.asin(_clip(z)))


def sidereal_hours(mjd: Column, longitude: float) -> Column:
    """Mean sidereal time at an east longitude, in hours."""
    d = mjd - 51544.5
    t = d / 36525.0
    gmst = 280.46061837 + 360.98564736629 * d + 0.000387933 * t * t - t * t * t / 38710000.0
    return F.pmod(gmst + longitude, F.lit(360.0)) / 15.0


def horizon(ra: Column, dec: Column, lst_hours: Column, latitude: float) -> tuple[Column, Column]:
    """Azimuth (from north over east) and elevation."""
    h, d, p = F.radians(lst_hours * 15.0 - ra), F.radians(dec), F.lit(math.radians(latitude))
    el = F.asin(_clip(F.sin(d) * F.sin(p) + F.cos(d) * F.cos(p) * F.cos(h)))
    az = F.atan2(-F.cos(d) * F.sin(h), F.sin(d) * F.cos(p) - F.cos(d) * F.cos(h) * F.sin(p))
    return F.pmod(F.degrees(az), F.lit(360.0)), F.degrees(el)


def from_horizon(az: Column, el: Column, lst_hours: Column, latitude: float) -> tuple[Column, Column]:
    """Right ascension and declination of a horizon position."""
    a, e, p = F.radians(az), F.radians(el), F.lit(math.radians(latitude))
    dec = F.asin(_clip(F.sin(e) * F.sin(p) + F.cos(e) * F.cos(p) * F.cos(a)))
    h = F.atan2(-F.cos(e) * F.sin(a), F.sin(e) * F.cos(p) - F.cos(e) * F.cos(a) * F.sin(p))
    return F.pmod(lst_hours * 15.0 - F.degrees(h), F.lit(360.0)), F.degrees(dec)


def parallactic(ra: Column, dec: Column, lst_hours: Column, latitude: float) -> Column:
    h, d, p = F.radians(lst_hours * 15.0 - ra), F.radians(dec), math.radians(latitude)
    return F.degrees(F.atan2(F.sin(h) * math.cos(p), math.sin(p) * F.cos(d) - math.cos(p) * F.sin(d) * F.cos(h)))


def bearing(lon: Column, lat: Column, lon1: Column, lat1: Column) -> Column:
    """Direction from one position to another, from north over east."""
    d, a, b = F.radians(lon1 - lon), F.radians(lat), F.radians(lat1)
    return F.degrees(F.atan2(F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d)))


def rotated(x: Column, y: Column, angle: Column) -> tuple[Column, Column]:
    """Offsets in axes that are turned by an angle."""
    a = F.radians(angle)
    return x * F.cos(a) + y * F.sin(a), y * F.cos(a) - x * F.sin(a)


def rotated_error(ex: Column, ey: Column, angle: Column) -> tuple[Column, Column]:
    """Errors of rotated offsets from independent errors."""
    c, s = F.pow(F.cos(F.radians(angle)), 2), F.pow(F.sin(F.radians(angle)), 2)
    return F.sqrt(ex * ex * c + ey * ey * s), F.sqrt(ex * ex * s + ey * ey * c)


def galactic_position_angle(lon: Column, lat: Column) -> Column:
    """Direction of the galactic pole, from equatorial north over east, in [0, 360)."""
    ra, dec = to_equatorial(lon, lat)
    pole_ra, pole_dec = to_equatorial(F.lit(0.0), F.lit(90.0))
    return F.pmod(bearing(ra, dec, pole_ra, pole_dec), F.lit(360.0))


def pointing_offsets(az: Column, el: Column, p: list[float]) -> tuple[Column, Column]:
    """Offsets to add to az and el, from a model's seven terms in radians: azimuth index, elevation index, non-perpendicularity, tilt west, tilt north, flexure, and an angle that turns the elevation's tilt."""
    index_az, index_el, square, west, north, flexure, turn = p
    a, e = F.radians(az), F.radians(el)
    across = index_az + F.tan(e) * (square + west * F.cos(a) + north * F.sin(a))
    return F.degrees(across / F.cos(e)), F.degrees(index_el + flexure * F.cos(e) + west * F.sin(a + turn) + north * F.cos(a + turn))


def pixel(lon: Column, lat: Column, wcs: dict[str, float]) -> Column:
    """The plate-carree pixel number y * nx + x, null outside the grid; fractions of a pixel are cut off."""
    x = F.lit(wcs["crpix1"] - 1.0) + (lon - wcs["crval1"]) / wcs["cdelt1"]
    y = F.lit(wcs["crpix2"] - 1.0) + (lat - wcs["crval2"]) / wcs["cdelt2"]
    inside = (x >= 0) & (y >= 0) & (x < wcs["nx"]) & (y < wcs["ny"])
    return F.when(inside, F.floor(y) * int(wcs["nx"]) + F.floor(x)).cast("bigint")


def pixel_centre(pix: Column, wcs: dict[str, float]) -> tuple[Column, Column]:
    nx = int(wcs["nx"])
    x, y = pix % nx, F.floor(pix / nx)
    return wcs["crval1"] + (x - (wcs["crpix1"] - 1.0)) * wcs["cdelt1"], wcs["crval2"] + (y - (wcs["crpix2"] - 1.0)) * wcs["cdelt2"]


def healpix_ring(lon: Column, lat: Column, nside: int) -> Column:
    """RING pixel number of a position."""
    z, tt = F.sin(F.radians(lat)), F.pmod(lon, F.lit(360.0)) / 90.0
    za = F.abs(z)
    # the equatorial belt
    t1, t2 = nside * (0.5 + tt), nside * 0.75 * z
    jp, jm = F.floor(t1 - t2), F.floor(t1 + t2)
    ir = nside + 1 + jp - jm
    shift = F.when(ir % 2 == 0, 1).otherwise(0)
    ip = F.pmod(F.floor((jp + jm - nside + shift + 1) / 2), F.lit(4 * nside))
    belt = 2 * nside * (nside - 1) + (ir - 1) * 4 * nside + ip
    # the caps
    tp = tt - F.floor(tt)
    root = nside * F.sqrt(3.0 * (1.0 - za))
    cp, cm = F.floor(tp * root), F.floor((1.0 - tp) * root)
    ring = cp + cm + 1
    at = F.pmod(F.floor(tt * ring), 4 * ring)
    cap = F.when(z > 0, 2 * ring * (ring - 1) + at).otherwise(12 * nside * nside - 2 * ring * (ring + 1) + at)
    return F.when(za <= 2.0 / 3.0, belt).otherwise(cap).cast("bigint")


def model_flux(source: Column, nu_ghz: Column, mjd: Column, model: str = "weiland_combined", fading: str = "weiland") -> Column:
    """Jy of a known calibrator at a time, by a published model and fading; null for others."""
    out = F.lit(None).cast("double")
    for name, models in FLUX.items():
        p, (fixed, slope) = models.get(model, models["weiland_combined"]), FADING[name].get(fading, FADING[name]["weiland"])
        x = F.log10(nu_ghz / p["ref"])
        years = (mjd - float(date(p["year"], 1, 1).toordinal() - 678576)) / 365.25
        fade = 1.0 - (fixed + slope * F.log10(nu_ghz)) * years if slope else 1.0 - fixed * years
        out = F.when(source == name, F.pow(F.lit(10.0), p["a"] + p["b"] * x + p["c"] * x * x) * fade).otherwise(out)
    return out


def jupiter_flux(nu_ghz: Column, distance_au: Column) -> Column:
    """Jy of Jupiter at a distance: a straight line through the logarithms of its temperatures."""
    x = [math.log10((34.688 - 0.5 * i) / 30.0) for i in range(len(JUPITER_KELVIN))]
    y = [math.log10(t) for t in JUPITER_KELVIN]
    mx, my = sum(x) / len(x), sum(y) / len(y)
    slope = sum((a - mx) * (b - my) for a, b in zip(x, y, strict=True)) / sum((a - mx) ** 2 for a in x)
    kelvin = F.pow(F.lit(10.0), my + slope * (F.log10(nu_ghz / 30.0) - mx))
    return kelvin * JUPITER_AREA * F.pow(5.2 / distance_au, 2) * 2.0 * BOLTZMANN * F.pow(nu_ghz * 1e9 / LIGHT, 2) * 1e26


def flux_error(flux: Column, *parts: tuple[Column, Column]) -> Column:
    """Error of a product from (value, error) of its factors, in quadrature."""
    total = F.lit(0.0)
    for value, error in parts:
        total = total + F.pow(F.try_divide(error, value), 2)
    return F.abs(flux) * F.sqrt(total)


def gaussian_flux(amplitude: Column, s1: Column, s2: Column, nu_ghz: Column) -> Column:
    """Jy of a Gaussian source with widths in degrees and amplitude in K."""
    area = 2.0 * math.pi * F.radians(s1) * F.radians(s2)
    return amplitude * area * 2.0 * BOLTZMANN * F.pow(nu_ghz * 1e9 / LIGHT, 2) * 1e26


def power_law(white: Column, red: Column, alpha: Column, k: Column, k_ref: float = 1.0) -> Column:
    """White plus red noise power at a frequency."""
    return white * white + red * red * F.pow(F.abs(k / k_ref), alpha)


def knee(white: Column, red: Column, alpha: Column, k_ref: float = 1.0) -> Column:
    return k_ref * F.pow(F.try_divide(white, red), F.try_divide(F.lit(2.0), alpha))


def receiver(hot: Column, cold: Column, load_kelvin: Column, sky_kelvin: float = 2.73) -> tuple[Column, Column]:
    """System temperature and gain from means on a warm load and on the sky."""
    y = F.try_divide(hot, cold)
    return F.try_divide(load_kelvin - y * sky_kelvin, y - 1.0), F.try_divide(hot - cold, load_kelvin - sky_kelvin)


def hour_angle(lst: Column, ra: Column) -> Column:
    """Sidereal time less right ascension, in degrees from -180 up to 180."""
    return F.pmod(lst - ra + 180.0, F.lit(360.0)) - 180.0


#: Arcseconds a Julian century, its square and its cube, of the three angles of equatorial precession from J2000.
PRECESSION = [(2306.2181, 0.30188, 0.017998), (2306.2181, 1.09468, 0.018203), (2004.3109, -0.42665, -0.041833)]


def precessed(ra: Column, dec: Column, mjd: Column) -> tuple[Column, Column]:
    """Right ascension and declination of the equinox of a date, in degrees, to those of J2000."""
    t = (mjd - 51544.5) / 36525.0
    zeta, z, theta = (F.radians((a * t + b * t * t + c * t * t * t) / 3600.0) for a, b, c in PRECESSION)
    # back from the date: turn by -z, tilt by theta, turn by -zeta
    at, d = F.radians(ra) - z, F.radians(dec)
    x = F.cos(theta) * F.cos(d) * F.cos(at) + F.sin(theta) * F.sin(d)
    y = F.cos(d) * F.sin(at)
    up = F.cos(theta) * F.sin(d) - F.sin(theta) * F.cos(d) * F.cos(at)
    return F.pmod(F.degrees(F.atan2(y, x) - zeta), F.lit(360.0)), F.degrees(F.asin(_clip(up)))


def refraction(elevation: Column, pressure_mb: Column, celsius: Column, least: float = 5.0) -> Column:
    """Degrees by which the air lifts a source at a true elevation (not taken below ``least`` degrees), by the usual two-term series for optical light."""
    cot = 1.0 / F.tan(F.radians(F.greatest(elevation, F.lit(least))))
    return (58.294 * cot - 0.0668 * cot * cot * cot) / 3600.0 * (pressure_mb / 1010.0) * (283.0 / (273.0 + celsius))


def sun(mjd: Column) -> tuple[Column, Column, Column]:
    """Right ascension and declination of the sun, in degrees, and its distance in astronomical units, to about 0.01 degrees."""
    n = mjd - 51544.5
    g = F.radians(357.528 + 0.9856003 * n)
    lon = F.radians(280.460 + 0.9856474 * n + 1.915 * F.sin(g) + 0.020 * F.sin(2 * g))
    tilt = F.radians(23.439 - 0.0000004 * n)
    ra = F.pmod(F.degrees(F.atan2(F.cos(tilt) * F.sin(lon), F.cos(lon))), F.lit(360.0))
    return ra, F.degrees(F.asin(F.sin(tilt) * F.sin(lon))), 1.00014 - 0.01671 * F.cos(g) - 0.00014 * F.cos(2 * g)


def galactic_horizon(lon: Column, lat: Column, lst_hours: Column, latitude: float) -> tuple[Column, Column]:
    """Azimuth and elevation of a galactic position."""
    ra, dec = to_equatorial(lon, lat)
    return horizon(ra, dec, lst_hours, latitude)
