"""Country name to continent name, as dimension tables to join with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Countries whose continent is set by hand; they win over the standard table.
OVERRIDES = {
    "Virgin Islands British": "North America",
    "Myanmar (Burma)": "Asia",
    "Antigua And Barbuda": "North America",
    "Saint Helena": "Africa",
    "Timor-Leste (East Timor)": "Asia",
    "Bosnia And Herzegovina": "Europe",
    "Saint Kitts And Nevis": "North America",
    "Democratic Republic Of The Congo": "Africa",
    "Saint Vincent And The Grenadines": "North America",
    "Antarctica": "Antarctica",
    "Wallis And Futuna": "Oceania",
    "Turks And Caicos Islands": "North America",
    "Isle Of Man": "Europe",
    "Trinidad And Tobago": "North America",
    "Sao Tome And Principe": "Africa",
    "Kosovo": "Europe",
    "Reunion": "Africa",
    "Saint Pierre And Miquelon": "North America",
    "Virgin Islands Us": "North America",
    "United States Minor Outlying Islands": "North America",
    "Western Sahara": "Africa",
    "South Georgia And The South Sandwich Islands": "Antarctica",
    "Saint Barthelemy": "North America",
    "Saint Martin": "North America",
    "Sint Maarten": "North America",
    "Palestinian Territory": "Asia",
    "French Southern Territories": "Antarctica",
    "Heard Island And Mcdonald Islands": "Antarctica",
    "Cocos Islands": "Asia",
    "Curacao": "North America",
    "Cape Verde": "Africa",
    "Caribbean Netherlands": "North America",
    "British Indian Ocean Territory": "Asia",
    "Bonaire Sint Eustatius And Saba": "North America",
    "Bouvet Island": "Antarctica",
    "American Samoa": "Oceania",
    "Anguilla": "North America",
    "Aruba": "North America",
    "Bermuda": "North America",
    "Bhutan": "Asia",
    "Cayman Islands": "North America",
    "Christmas Island": "Asia",
    "Cocos Keeling Islands": "Asia",
    "Cook Islands": "Oceania",
    "Falkland Islands": "South America",
    "Faroe Islands": "Europe",
    "French Polynesia": "Oceania",
    "French Guiana": "South America",
    "Gibraltar": "Europe",
    "Greenland": "North America",
    "Guadeloupe": "North America",
    "Guam": "Oceania",
    "Guernsey": "Europe",
    "Hong Kong": "Asia",
}

# Two-letter continent codes.
CONTINENTS = {
    "AF": "Africa",
    "AN": "Antarctica",
    "AS": "Asia",
    "EU": "Europe",
    "NA": "North America",
    "OC": "Oceania",
    "SA": "South America",
}

_DIMENSION = "country string, continent string"


def override_continents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(OVERRIDES.items()), _DIMENSION)


def standard_continents(names: DataFrame, codes: DataFrame) -> DataFrame:
    """Chain ``names`` (country, alpha2) and ``codes`` (alpha2, continent_code) to continent names."""
    code = F.upper("continent_code")
    continent = F.create_map(*[F.lit(v) for item in CONTINENTS.items() for v in item])[code]
    return names.join(codes, "alpha2").select("country", continent.alias("continent"))


# Short names of the other countries by continent code.
COUNTRIES = {
    "AF": (
        "Algeria, Angola, Benin, Botswana, Burkina Faso, Burundi, Cameroon, Central African Republic, Chad, Comoros, "
        "Congo, Cote D'ivoire, Djibouti, Egypt, Equatorial Guinea, Eritrea, Eswatini, Ethiopia, Gabon, Gambia, Ghana, "
        "Guinea, Guinea-Bissau, Ivory Coast, Kenya, Lesotho, Liberia, Libya, Madagascar, Malawi, Mali, Mauritania, "
        "Mauritius, Mayotte, Morocco, Mozambique, Namibia, Niger, Nigeria, Rwanda, Senegal, Seychelles, Sierra Leone, "
        "Somalia, South Africa, South Sudan, Sudan, Swaziland, Tanzania, Togo, Tunisia, Uganda, Zambia, Zimbabwe"
    ),
    "AS": (
        "Afghanistan, Armenia, Azerbaijan, Bahrain, Bangladesh, Brunei, Brunei Darussalam, Cambodia, China, Cyprus, "
        "Georgia, India, Indonesia, Iran, Iraq, Israel, Japan, Jordan, Kazakhstan, Kuwait, Kyrgyzstan, Laos, Lebanon, "
        "Macao, Malaysia, Maldives, Mongolia, Nepal, North Korea, Oman, Pakistan, Philippines, Qatar, Saudi Arabia, "
        "Singapore, South Korea, Sri Lanka, Syria, Taiwan, Tajikistan, Thailand, Turkey, Turkmenistan, "
        "United Arab Emirates, Uzbekistan, Vietnam, Yemen"
    ),
    "EU": (
        "Albania, Andorra, Austria, Belarus, Belgium, Bulgaria, Croatia, Czech Republic, Czechia, Denmark, Estonia, "
        "Finland, France, Germany, Greece, Hungary, Iceland, Ireland, Italy, Jersey, Latvia, Liechtenstein, Lithuania, "
        "Luxembourg, Malta, Moldova, Monaco, Montenegro, Netherlands, North Macedonia, Norway, Poland, Portugal, "
        "Romania, Russia, San Marino, Serbia, Slovakia, Slovenia, Spain, Svalbard And Jan Mayen, Sweden, Switzerland, "
        "Ukraine, United Kingdom"
    ),
    "NA": (
        "Bahamas, Barbados, Belize, Canada, Costa Rica, Cuba, Dominica, Dominican Republic, El Salvador, Grenada, "
        "Guatemala, Haiti, Honduras, Jamaica, Martinique, Mexico, Montserrat, Nicaragua, Panama, Puerto Rico, "
        "Saint Lucia, United States"
    ),
    "OC": (
        "Australia, Fiji, Kiribati, Marshall Islands, Micronesia, Nauru, New Caledonia, New Zealand, Niue, "
        "Norfolk Island, Northern Mariana Islands, Palau, Papua New Guinea, Samoa, Solomon Islands, Tokelau, Tonga, "
        "Tuvalu, Vanuatu"
    ),
    "SA": "Argentina, Bolivia, Brazil, Chile, Colombia, Ecuador, Guyana, Paraguay, Peru, Suriname, Uruguay, Venezuela",
}


def built_in_continents(spark: SparkSession) -> DataFrame:
    """The standard table: short English names, one row each."""
    rows = [(name, CONTINENTS[code]) for code, names in COUNTRIES.items() for name in names.split(", ")]
    return spark.createDataFrame(rows, _DIMENSION)
