"""Values of the worked example that have to be as they are for the results to be right."""

# Accepted years.
EXPORT_YEARS = (1990, 2030)
INDICATOR_YEARS = (1960, 2030)

# Product categories and English product names.
PRODUCT_CATEGORIES = {
    "Oilseeds": ["soja", "girasol", "maní", "colza", "cártamo"],
    "Grains": ["trigo", "maíz", "cebada", "sorgo", "avena", "centeno", "arroz"],
    "Livestock": ["carne bovina", "carne porcina", "carne ovina", "miel", "lana", "cuero"],
    "Citrus": ["limón", "naranja", "mandarina", "pomelo"],
    "Fruits": ["manzana", "pera", "uva", "cereza", "arándano", "frutilla"],
}
OTHER_CATEGORY = "Other"
PRODUCT_NAMES = {
    "soja": "Soybean", "girasol": "Sunflower", "maíz": "Corn", "trigo": "Wheat", "cebada": "Barley",
    "sorgo": "Sorghum", "maní": "Peanut", "colza": "Canola", "arroz": "Rice", "carne bovina": "Beef",
    "carne porcina": "Pork", "carne ovina": "Lamb", "miel": "Honey", "lana": "Wool", "cuero": "Leather",
    "limón": "Lemon", "naranja": "Orange", "mandarina": "Tangerine", "manzana": "Apple", "pera": "Pear",
    "uva": "Grape", "cereza": "Cherry", "arándano": "Blueberry",
}

# Provinces of the Pampa region and main crop by province.
PAMPA_PROVINCES = ["buenos aires", "córdoba", "santa fe", "entre ríos", "la pampa"]
MAIN_CROPS = {
    "wheat": ["buenos aires", "la pampa"],
    "soybean": ["córdoba", "santa fe", "entre ríos"],
    "grape": ["mendoza"],
    "lemon": ["tucumán"],
    "apple": ["río negro", "neuquén"],
    "yerba mate": ["misiones"],
    "tobacco": ["salta"],
    "cotton": ["chaco"],
}
OTHER_CROP = "mixed"

# Weather stations (province, latitude, longitude).
STATIONS = [
    ("buenos_aires", -34.6, -58.4),
    ("cordoba", -31.4, -64.2),
    ("santa_fe", -31.6, -60.7),
    ("entre_rios", -31.7, -60.5),
    ("la_pampa", -36.6, -64.3),
    ("salta", -24.8, -65.4),
    ("tucuman", -26.8, -65.2),
]

# Arrays of the weather payload and the columns they become.
WEATHER_FIELDS = {
    "temperature_2m_max": "temp_max_c",
    "temperature_2m_min": "temp_min_c",
    "precipitation_sum": "precipitation_mm",
    "wind_speed_10m_max": "wind_speed_max_kmh",
    "et0_fao_evapotranspiration": "evapotranspiration_mm",
}

# Indicators by name.
INDICATORS = {
    "cereal_production_mt": "AG.PRD.CREL.MT",
    "crop_production_index": "AG.PRD.CROP.XD",
    "cereal_yield_kg_ha": "AG.YLD.CREL.KG",
    "agri_land_km2": "AG.LND.AGRI.K2",
    "agri_land_pct": "AG.LND.AGRI.ZS",
}
INDICATOR_COUNTRY = "ARG"

# First day of the date dimension and the day after its last.
DATES_FROM = "1993-01-01"
DATES_UNTIL = "2031-01-01"

# Spellings that name one place in the two export sources; used where canonical keys are asked for.
PLACE_ALIASES = {"pba": "buenos aires", "espania": "espana"}
