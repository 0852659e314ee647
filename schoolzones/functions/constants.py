"""Fixed values the results depend on: word lists, lookup tables, bin limits."""

# --- Fixed values: course titles (lower case) -------------------------------
APPROVED_TITLES = [
    "advanced placement computer science a",
    "advanced placement computer science principles",
    "ib computer science, year one",
    "ib computer science, year two",
    "computer science principles",
    "programming, games, apps, and society",
    "web development",
    "embedded computing",
    "game design: animation and simulation",
    "introduction to cybersecurity",
    "advanced cybersecurity",
    "coding for fintech",
    "introduction to python",
]
EXPANDED_TITLES = APPROVED_TITLES + [
    "introduction to software technology",
    "introduction to digital technology",
    "introduction to hardware technology",
]
# The older, case-sensitive spelling of the approved titles.
OLDER_APPROVED_TITLES = [
    "Advanced Placement, Computer Science A",
    "Advanced Placement Computer Science Principles",
    "Computer Science Principles",
    "Introduction to Cybersecurity",
    "Advanced Cybersecurity",
    "IB Computer Science, Year One",
    "IB Computer Science, Year Two",
    "Embedded Computing",
    "Game Design: Animation and Simulation",
    "Programming, Games, Apps and Society",
    "Web Development",
    "Introduction to Python",
    "Coding for FinTech",
]

# --- Fixed values: text markers ---------------------------------------------
MISSING_MARKERS = ["n/a", "N/A", ".", ""]
VIRTUAL_LABELS = [
    "software-based instruction",
    "gavs virtual teacher",
    "virtual school (non-gavs)",
]
VIRTUAL_CONTAINS = "de:"
OLDER_VIRTUAL_LABELS = [
    "GAVS Virtual Teacher",
    "Virtual School (Non-GAVS)",
    "Software-Based Instruction",
]
OLDER_VIRTUAL_PREFIX = "DE:"

# --- Fixed values: grade span ------------------------------------------------
GRADE_WORDS = [("PK", "0"), ("KK", "0.5")]
GRADE_SEPARATORS = "[,-]"
GRADE_NUMBER = r"\A[0-9.]+\z"
LOWEST_GRADE = 9
HIGHEST_GRADE = 12

# --- Fixed values: name patterns of schools that are left out ----------------
SCHOOL_NAME_PATTERNS = [
    "%Academy%", "%STEM%", "%Charter%", "%State Schools%", "%Virtual%", "%Institute%",
    "%Foundry%", "%Transition%", "%Center%", "%Online%", "%Intervention%", "%S.T.E.M.%",
    "%Treatment%", "%Youth%", "%Home%", "%Ministries%", "%Chance%", "%Comprehensive%",
    "%Career%", "%Arts%", "%E-Learning%", "%Humanities%", "%ITU%",
]
SYSTEM_NAME_PATTERNS = ["%charter%", "%state%", "%academy%"]

# --- Fixed values: locale classes and catchment radii -------------------------
LOCALE_BANDS = [("City", 11, 19), ("Suburb", 21, 29), ("Town", 31, 39), ("Rural", 41, 49)]
UNKNOWN_LOCALE = "Unknown"
BUFFER_MILES = [("City", 1.0), ("Suburb", 3.0), ("Town", 7.0), ("Rural", 18.0)]
METRES_PER_MILE = 1609.34

# --- Fixed values: representation ----------------------------------------------
RI_LIMIT = 0.05
RI_GROUPS = ["asian", "black", "hispanic", "white", "female"]
RACES = ["White", "Black", "Asian", "Hispanic"]
DEMOGRAPHICS = ["asian", "black", "white", "hispanic", "female", "male"]

# --- Fixed values: closed ranges (low, high, colour) of each school layer -------
# A bound of None is open.
RI_FEMALE_RANGES = [
    (-0.864929, -0.296520, "#7f2704"),
    (-0.296519, -0.211112, "#d94801"),
    (-0.211111, -0.051748, "#fdae6b"),
    (-0.051747, 0.032609, "#ffffff"),
    (0.034510, 0.257576, "#9ecae1"),
    (0.257577, 0.497095, "#3182bd"),
    (0.497096, 0.652174, "#08519c"),
]
RI_ASIAN_RANGES = [
    (None, -0.050279, "#d94801"),
    (-0.050278, 0.049733, "#fdae6b"),
    (0.049734, 0.083157, "#ffffff"),
    (0.083158, 0.138494, "#9ecae1"),
]
RI_ASIAN_OTHERWISE = "#3182bd"
RI_HISPANIC_RANGES = [
    (-0.357664, -0.125772, "#7f2704"),
    (-0.125771, -0.077977, "#d94801"),
    (-0.077976, -0.050622, "#fdae6b"),
    (-0.050621, 0.053994, "#ffffff"),
    (0.053995, 0.082208, "#9ecae1"),
    (0.082209, 0.159554, "#3182bd"),
    (0.159555, 0.951422, "#08519c"),
]
RI_BLACK_RANGES = [
    (-0.864929, -0.168258, "#7f2704"),
    (-0.168257, -0.088616, "#d94801"),
    (-0.088615, -0.050715, "#fdae6b"),
    (-0.050714, 0.049845, "#ffffff"),
    (0.049846, 0.088608, "#9ecae1"),
    (0.088609, 0.139144, "#3182bd"),
    (0.139145, 0.684211, "#08519c"),
]
# Touching ranges, given as edges; the lower range owns a shared edge.
SEVEN_COLOURS = ["#7f2704", "#d94801", "#fdae6b", "#ffffff", "#9ecae1", "#3182bd", "#08519c"]
RI_WHITE_EDGES = [-0.627130, -0.168843, -0.082320, -0.050197, 0.049292, 0.090172, 0.162600, 0.981273]
RI_BLACK_EDGES = [-0.864929, -0.168258, -0.088616, -0.050715, 0.049845, 0.088608, 0.139144, 0.684211]

# --- Fixed values: block-group underlay bins (edges, lowest edge included?) ------
BLACK_RATIO_BINS = ([0.0, 0.1253, 0.3157, 0.5369, 0.7838, 1.0], False)
INCOME_BINS = ([2499.0, 53240.0, 84175.0, 122700.0, 180134.0, 250001.0], True)
EDUCATION_BINS = ([0.0, 508.0, 832.0, 1199.0, 1711.0, 3965.0], True)
INTERNET_BINS = ([0.0, 288.0, 472.0, 679.0, 965.0, 2070.0], True)
QUANTILE_BINS = 5

# --- Fixed values: regional box (degrees), map padding ---------------------------
REGION_BOX = (-85.5, 32.8, -82.8, 34.5)  # min lon, min lat, max lon, max lat
EXTENT_PADDING = 0.05
STATE_CODE = "13"
INTERSTATE = "I"

# --- Fixed values: modality of a three-digit logic code ---------------------------
# (first two digits, class, legend label, colour)
MODALITIES = [
    ("11", "Both", "In Person and Virtual", "#47CEF5"),
    ("10", "In Person", "In Person Only", "#F54777"),
    ("01", "Virtual", "Virtual Only", "#FFB300"),
]
NO_MODALITY = ("No", "No approved CS Class", "#636363")
# (first two digits, last digit, marker, legend label, shape, colour)
MARKERS = [
    ("11", "1", "Purple Triangle", "In Person and Virtual with Extra Teachers", "^", "#47CEF5"),
    ("11", "0", "Purple Circle", "In Person and Virtual without Extra Teachers", "o", "#47CEF5"),
    ("10", "1", "Pink Triangle", "In Person with Extra Teachers", "^", "#F54777"),
    ("10", "0", "Pink Circle", "In Person without Extra Teachers", "o", "#F54777"),
    ("01", "1", "Yellow Triangle", "Virtual with Extra Teachers", "^", "#FFB300"),
    ("01", "0", "Yellow Circle", "Virtual without Extra Teachers", "o", "#FFB300"),
    ("00", "1", "Gray Triangle", "No CS with Extra Teachers", "^", "#636363"),
    ("00", "0", "Gray Circle", "No CS without Extra Teachers", "o", "#636363"),
]
OTHER_MARKER = "Other"

# --- Fixed values: plotted metrics: name -> metric column of each race --------------
SHARE_METRICS = [
    "edu_less_than_hs",
    "edu_hs_or_more",
    "without_internet_subscription",
    "households_no_computer",
]
POPULATION_GROUPS = {
    "White": "white_alone_non_hispanic",
    "Black": "black_alone_non_hispanic",
    "Asian": "asian_alone_non_hispanic",
    "Hispanic": "hispanic_or_latino",
}
DISTRIBUTION_METRICS = {
    "Income": "total_pop_weighted_avg_income",
    "Harmonic Mean Distance": {
        race: f"{group}_population_avg_distance" for race, group in POPULATION_GROUPS.items()
    },
    "No Computer": "weighted_avg_households_no_computer",
    "Comp But No Internet": "weighted_avg_without_internet_subscription",
    "Less than High School": "weighted_avg_edu_less_than_hs",
    "Completed HS and Higher": "weighted_avg_edu_hs_or_more",
}
# Density curve (bandwidth in standard deviations, grid points).
DENSITY_BANDWIDTH = 0.2
DENSITY_GRID = 100

# --- Fixed values: projections -------------------------------------------------------
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101
CONIC_PARALLELS = (33.0, 45.0)
CONIC_ORIGIN = (-96.0, 39.0)  # lon, lat
MERCATOR_R = 6378137.0
