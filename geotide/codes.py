"""Fixed values of the feeds' code tables.

These must equal the values that consumers of the feeds know; they are data,
kept together and in natural order.
"""

from __future__ import annotations

#: Emitter categories by code, 0 to 17.
EMITTER_CATEGORIES = [
    "none", "none", "light", "small", "large", "high_vortex_large", "heavy", "high_performance", "rotorcraft", "glider", "lighter_than_air", "parachutist",
    "ultralight", "reserved", "uav", "space", "surface_emergency", "surface_service",
]

#: Navigational states by code, 0 to 15.
NAV_STATES = [
    "under_way_using_engine", "at_anchor", "not_under_command", "restricted_manoeuvrability", "constrained_by_draught", "moored", "aground",
    "engaged_in_fishing", "under_way_sailing", "reserved_hsc", "reserved_wig", "reserved_11", "reserved_12", "reserved_13", "ais_sart", "not_defined",
]

#: Ship types as (first code, last code, label).
SHIP_TYPES = [
    (0, 0, ""), (20, 29, "wing_in_ground"), (30, 30, "fishing"), (31, 32, "towing"), (33, 33, "dredging"), (34, 34, "diving"),
    (35, 35, "military"), (36, 36, "sailing"), (37, 37, "pleasure_craft"), (40, 49, "high_speed_craft"), (50, 50, "pilot"),
    (51, 51, "search_and_rescue"), (52, 52, "tug"), (53, 53, "port_tender"), (55, 55, "law_enforcement"), (58, 58, "medical"),
    (60, 69, "passenger"), (70, 79, "cargo"), (80, 89, "tanker"),
]
#: Label by tens digit of codes without a label of their own.
SHIP_TYPE_TENS = {1: "reserved", 2: "wing_in_ground", 3: "special", 4: "high_speed_craft", 5: "special", 6: "passenger", 7: "cargo", 8: "tanker", 9: "other"}

#: Default-free-zone providers.
TIER1_ASNS = [174, 209, 701, 1239, 1299, 2828, 2914, 3257, 3320, 3356, 3491, 5511, 6453, 6461, 6762, 6830, 7018, 12956]

#: Well-known autonomous systems and the country each is drawn in.
SEED_ASNS = {
    15169: "US", 13335: "US", 16509: "US", 8075: "US", 32934: "US", 2906: "US", 14907: "US", 54113: "US", 20940: "US", 13414: "US",
    36351: "US", 14061: "US", 3561: "US", 174: "US", 701: "US", 1299: "SE", 2914: "JP", 3257: "US", 3320: "DE", 3356: "US",
    3491: "US", 5511: "FR", 6453: "US", 6461: "US", 6762: "IT", 6830: "LU", 7018: "US", 12956: "ES", 2856: "GB", 5089: "GB",
    3215: "FR", 6805: "DE", 12389: "RU", 8359: "RU", 12322: "FR", 20485: "RU", 4134: "CN", 4837: "CN", 9808: "CN", 4766: "KR",
    9299: "PH", 4755: "IN", 55836: "IN", 22773: "US", 7303: "AR", 8151: "MX", 8452: "EG", 36947: "DZ", 3216: "RU", 31133: "RU",
    34984: "TR", 9002: "UA", 6939: "US",
}

#: Country centroids (lat, lon) at which systems without a closer position are drawn; a refreshed table is a parameter of the loaders.
CENTROIDS = {
    "AD": (42.506, 1.521), "AE": (23.424, 53.847), "AF": (33.939, 67.709), "AG": (17.060, -61.796), "AL": (41.153, 20.168),
    "AM": (40.069, 45.038), "AO": (-11.202, 17.873), "AR": (-38.416, -63.616), "AT": (47.516, 14.550), "AU": (-25.274, 133.775),
    "AZ": (40.143, 47.577), "BA": (43.915, 17.679), "BB": (13.193, -59.543), "BD": (23.685, 90.356), "BE": (50.503, 4.470),
    "BF": (12.238, -1.561), "BG": (42.733, 25.486), "BH": (25.930, 50.638), "BI": (-3.373, 29.919), "BJ": (9.307, 2.315),
    "BN": (4.535, 114.728), "BO": (-16.290, -63.589), "BR": (-14.235, -51.925), "BS": (25.034, -77.396), "BT": (27.514, 90.434),
    "BW": (-22.328, 24.685), "BY": (53.709, 27.953), "BZ": (17.190, -88.497), "CA": (56.130, -106.347), "CD": (-4.038, 21.759),
    "CF": (6.611, 20.939), "CG": (-0.228, 15.828), "CH": (46.818, 8.228), "CI": (7.540, -5.547), "CL": (-35.675, -71.543),
    "CM": (7.370, 12.355), "CN": (35.862, 104.195), "CO": (4.571, -74.297), "CR": (9.749, -83.754), "CU": (21.522, -77.781),
    "CV": (16.538, -23.048), "CY": (35.127, 33.430), "CZ": (49.818, 15.473), "DE": (51.166, 10.452), "DJ": (11.825, 42.590),
    "DK": (56.264, 9.502), "DM": (15.415, -61.371), "DO": (18.735, -70.163), "DZ": (28.034, 1.660), "EC": (-1.831, -78.184),
    "EE": (58.596, 25.014), "EG": (26.821, 30.803), "ER": (15.179, 39.782), "ES": (40.464, -3.750), "ET": (9.145, 40.490),
    "FI": (61.924, 25.748), "FJ": (-16.578, 179.414), "FR": (46.228, 2.214), "GA": (-0.804, 11.609), "GB": (55.378, -3.436),
    "GD": (12.263, -61.605), "GE": (42.316, 43.357), "GH": (7.946, -1.024), "GM": (13.444, -15.311), "GN": (9.946, -9.697),
    "GQ": (1.651, 10.268), "GR": (39.074, 21.824), "GT": (15.783, -90.231), "GW": (11.804, -15.180), "GY": (4.861, -58.930),
    "HK": (22.320, 114.170), "HN": (15.200, -86.242), "HR": (45.100, 15.200), "HT": (18.971, -72.286), "HU": (47.162, 19.503),
    "ID": (-0.789, 113.921), "IE": (53.413, -8.244), "IL": (31.046, 34.852), "IN": (20.594, 78.963), "IQ": (33.223, 43.679),
    "IR": (32.428, 53.688), "IS": (64.963, -19.021), "IT": (41.872, 12.567), "JM": (18.109, -77.298), "JO": (30.585, 36.238),
    "JP": (36.205, 138.253), "KE": (-0.024, 37.906), "KG": (41.204, 74.766), "KH": (12.566, 104.991), "KI": (-3.371, -168.734),
    "KM": (-11.645, 43.334), "KP": (40.340, 127.510), "KR": (35.908, 127.767), "KW": (29.312, 47.482), "KZ": (48.020, 66.924),
    "LA": (19.856, 102.495), "LB": (33.855, 35.862), "LC": (13.909, -60.979), "LI": (47.166, 9.555), "LK": (7.874, 80.772),
    "LR": (6.428, -9.429), "LS": (-29.610, 28.234), "LT": (55.169, 23.881), "LU": (49.815, 6.130), "LV": (56.880, 24.603),
    "LY": (26.335, 17.229), "MA": (31.792, -7.093), "MC": (43.750, 7.413), "MD": (47.412, 28.370), "ME": (42.709, 19.374),
    "MG": (-18.767, 46.869), "MH": (7.131, 171.185), "MK": (41.608, 21.745), "ML": (17.571, -3.996), "MM": (21.914, 95.956),
    "MN": (46.862, 103.847), "MO": (22.199, 113.544), "MR": (21.008, -10.941), "MT": (35.937, 14.375), "MU": (-20.348, 57.552),
    "MV": (3.203, 73.221), "MW": (-13.254, 34.302), "MX": (23.635, -102.553), "MY": (4.211, 101.976), "MZ": (-18.666, 35.530),
    "NA": (-22.958, 18.490), "NE": (17.608, 8.082), "NG": (9.082, 8.675), "NI": (12.866, -85.207), "NL": (52.133, 5.291),
    "NO": (60.472, 8.469), "NP": (28.394, 84.124), "NR": (-0.523, 166.932), "NZ": (-40.901, 174.886), "OM": (21.513, 55.923),
    "PA": (8.538, -80.782), "PE": (-9.190, -75.015), "PG": (-6.315, 143.955), "PH": (12.879, 121.774), "PK": (30.375, 69.345),
    "PL": (51.919, 19.145), "PS": (31.952, 35.233), "PT": (39.400, -8.224), "PW": (7.515, 134.582), "PY": (-23.443, -58.444),
    "QA": (25.355, 51.184), "RO": (45.943, 24.967), "RS": (44.016, 21.006), "RU": (61.524, 105.319), "RW": (-1.940, 29.874),
    "SA": (23.886, 45.079), "SB": (-9.646, 160.157), "SC": (-4.680, 55.492), "SD": (12.863, 30.218), "SE": (60.128, 18.644),
    "SG": (1.352, 103.820), "SI": (46.151, 14.995), "SK": (48.669, 19.699), "SL": (8.461, -11.780), "SM": (43.942, 12.458),
    "SN": (14.497, -14.452), "SO": (5.152, 46.199), "SR": (3.919, -56.028), "SS": (6.877, 31.307), "ST": (0.186, 6.613),
    "SV": (13.794, -88.897), "SY": (34.802, 38.997), "SZ": (-26.523, 31.466), "TD": (15.454, 18.732), "TG": (8.619, 0.825),
    "TH": (15.870, 100.993), "TJ": (38.861, 71.276), "TL": (-8.874, 125.728), "TM": (38.970, 59.556), "TN": (33.887, 9.537),
    "TO": (-21.179, -175.198), "TR": (38.964, 35.243), "TT": (10.692, -61.223), "TV": (-7.110, 177.649), "TW": (23.698, 120.961),
    "TZ": (-6.369, 34.889), "UA": (48.379, 31.166), "UG": (1.374, 32.290), "US": (37.090, -95.713), "UY": (-32.523, -55.766),
    "UZ": (41.377, 64.585), "VC": (12.984, -61.287), "VE": (6.423, -66.590), "VN": (14.058, 108.277), "VU": (-15.377, 166.959),
    "WS": (-13.759, -172.105), "XK": (42.602, 20.903), "YE": (15.553, 48.516), "ZA": (-30.559, 22.937), "ZM": (-13.134, 27.849),
    "ZW": (-19.015, 29.155),
}

#: Orbit thresholds: km, eccentricity, rev/day, degrees, days.
EARTH_RADIUS_KM, EARTH_MU, GEO_AXIS_KM, GEO_TOLERANCE_KM, LEO_ALTITUDE_KM, HEO_ECCENTRICITY = 6371.0, 398600.4418, 42164.0, 200.0, 2000.0, 0.25
MANEUVER_MEAN_MOTION, MANEUVER_INCLINATION, DECAY_PERIGEE_KM, DECAY_BSTAR = 0.01, 0.1, 150.0, 0.01
STALE_DAYS = {"leo": 14, "heo": 14, "meo": 30, "geo": 30}
TICK_SECONDS = {"leo": 30, "meo": 60, "geo": 120, "heo": 30}

#: Cell resolutions at which live events are broadcast.
TELEMETRY_RESOLUTIONS, BGP_RESOLUTIONS, STORED_RESOLUTION = [2, 3, 4, 5, 6, 7], [3], 7

#: Micro-batching: rows and seconds of the store path, rows and milliseconds of the live path; kept prefixes.
STORE_ROWS, STORE_SECONDS, LIVE_ROWS, LIVE_MILLIS, MAX_PREFIXES = 10_000, 2, 500, 50, 500_000
KNOTS = 1.94384
