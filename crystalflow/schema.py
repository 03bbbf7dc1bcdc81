"""Table schemas and the fixed values shared by every source.

All documents are read with these explicit types. Nothing is inferred: raw
documents are ragged and keyed by value, which inference would turn into
thousands of columns.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: enumerations -------------------------------------------
FUNCTIONALS = ["pbe", "pbesol", "scan", "r2scan"]
SOURCES = ["alexandria", "mp", "oqmd"]

# --- fixed values: calculation label prefix -> functional -----------------
LABEL_FUNCTIONALS = {
    "GGA": "pbe",
    "GGA+U": "pbe",
    "PBEsol": "pbesol",
    "r2SCAN": "r2scan",
    "SCAN": "scan",
}

# --- fixed values: task types ---------------------------------------------
STATIC = "Static"
STRUCTURE_OPTIMIZATION = "Structure Optimization"

# --- fixed values: dump calculation labels, in order of preference --------
STATIC_LABELS = ["static"]
RELAXATION_LABELS = ["relaxation", "coarse_relax", "fine_relax"]

# --- fixed values: elements that break cross-compatibility, per source ----
INCOMPATIBLE_ELEMENTS = {
    "mp": ["Cs", "V"],
    "alexandria": ["Yb"],
    "oqmd": ["Ca", "Ce", "Cr", "Eu", "Mn", "Mo", "Rh", "Ru", "Ti", "Tl", "V", "W", "Yb"],
}

# --- fixed values: tolerances ---------------------------------------------
MAX_FRAME_ENERGY_ABOVE_LAST = 1.0  # eV per atom
PRIMARY_ENERGY_TOLERANCE = 0.02  # eV per atom
MAX_FORCE = 0.1  # eV per angstrom
RATIO_REL_TOL = 1e-5
RATIO_ABS_TOL = 1e-8

# --- fixed values: energy-correction eligibility --------------------------
UNCORRECTABLE_ELEMENTS = ["At", "Po"]
HUBBARD_ANIONS = ["F", "O"]
HUBBARD_ELEMENTS = ["Co", "Cr", "Fe", "Mn", "Mo", "Ni", "V", "W"]
NO_VANADIUM_SOURCES = ["mp", "oqmd"]

TRAJECTORY_LICENSE = "BY-C"

# --- fixed values: chemical element symbols by atomic number; D and T are
# the hydrogen isotopes the symbol check also accepts ----------------------
ELEMENT_SYMBOLS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn "
    "Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba La Ce "
    "Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn "
    "Fr Ra Ac Th Pa U Np Pu Am Cm Bk Cf Es Fm Md No Lr Rf Db Sg Bh Hs Mt Ds Rg Cn Nh Fl "
    "Mc Lv Ts Og D T"
).split()

# --- fixed values: Pauling electronegativities (public reference values);
# elements without one sort last -------------------------------------------
ELECTRONEGATIVITY = {
    "H": 2.20, "Li": 0.98, "Be": 1.57, "B": 2.04, "C": 2.55, "N": 3.04, "O": 3.44, "F": 3.98,
    "Na": 0.93, "Mg": 1.31, "Al": 1.61, "Si": 1.90, "P": 2.19, "S": 2.58, "Cl": 3.16,
    "K": 0.82, "Ca": 1.00, "Sc": 1.36, "Ti": 1.54, "V": 1.63, "Cr": 1.66, "Mn": 1.55,
    "Fe": 1.83, "Co": 1.88, "Ni": 1.91, "Cu": 1.90, "Zn": 1.65, "Ga": 1.81, "Ge": 2.01,
    "As": 2.18, "Se": 2.55, "Br": 2.96, "Kr": 3.00, "Rb": 0.82, "Sr": 0.95, "Y": 1.22,
    "Zr": 1.33, "Nb": 1.60, "Mo": 2.16, "Tc": 1.90, "Ru": 2.20, "Rh": 2.28, "Pd": 2.20,
    "Ag": 1.93, "Cd": 1.69, "In": 1.78, "Sn": 1.96, "Sb": 2.05, "Te": 2.10, "I": 2.66,
    "Xe": 2.60, "Cs": 0.79, "Ba": 0.89, "La": 1.10, "Ce": 1.12, "Pr": 1.13, "Nd": 1.14,
    "Pm": 1.13, "Sm": 1.17, "Eu": 1.20, "Gd": 1.20, "Tb": 1.10, "Dy": 1.22, "Ho": 1.23,
    "Er": 1.24, "Tm": 1.25, "Yb": 1.10, "Lu": 1.27, "Hf": 1.30, "Ta": 1.50, "W": 2.36,
    "Re": 1.90, "Os": 2.20, "Ir": 2.20, "Pt": 2.28, "Au": 2.54, "Hg": 2.00, "Tl": 1.62,
    "Pb": 2.33, "Bi": 2.02, "Po": 2.00, "At": 2.20, "Rn": 2.20, "Fr": 0.70, "Ra": 0.90,
    "Ac": 1.10, "Th": 1.30, "Pa": 1.50, "U": 1.38, "Np": 1.36, "Pu": 1.28, "Am": 1.30,
    "Cm": 1.30, "Bk": 1.30, "Cf": 1.30, "Es": 1.30, "Fm": 1.30, "Md": 1.30, "No": 1.30,
}

# --- fixed values: formulas conventionally written doubled (molecules and
# peroxides keep a factor of two when a composition is reduced) ------------
DOUBLED_FORMULAS = ["H", "N", "O", "F", "Cl", "LiO", "NaO", "KO", "HO", "CsO", "RbO"]

VECTOR = T.ArrayType(T.DoubleType())
MATRIX = T.ArrayType(VECTOR)

SPECIES = T.ArrayType(
    T.StructType(
        [
            T.StructField("mass", T.DoubleType()),
            T.StructField("name", T.StringType()),
            T.StructField("attached", T.StringType()),
            T.StructField("nattached", T.IntegerType()),
            T.StructField("concentration", VECTOR),
            T.StructField("original_name", T.StringType()),
            T.StructField("chemical_symbols", T.ArrayType(T.StringType())),
        ]
    )
)


def _fields(pairs) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in pairs])


#: Raw document table: one row per upstream document.
RAW = _fields(
    [
        ("id", T.StringType()),
        ("type", T.StringType()),
        ("attributes", T.StringType()),
        ("last_modified", T.TimestampType()),
    ]
)

#: Curated structure table.
STRUCTURE = _fields(
    [
        ("id", T.StringType()),
        ("source", T.StringType()),
        ("elements", T.ArrayType(T.StringType())),
        ("nelements", T.IntegerType()),
        ("elements_ratios", VECTOR),
        ("nsites", T.IntegerType()),
        ("cartesian_site_positions", MATRIX),
        ("lattice_vectors", MATRIX),
        ("species_at_sites", T.ArrayType(T.StringType())),
        ("species", SPECIES),
        ("chemical_formula_anonymous", T.StringType()),
        ("chemical_formula_reduced", T.StringType()),
        ("chemical_formula_descriptive", T.StringType()),
        ("dimension_types", T.ArrayType(T.IntegerType())),
        ("nperiodic_dimensions", T.IntegerType()),
        ("immutable_id", T.StringType()),
        ("last_modified", T.TimestampType()),
        ("stress_tensor", MATRIX),
        ("energy", T.DoubleType()),
        ("energy_corrected", T.DoubleType()),
        ("magnetic_moments", VECTOR),
        ("forces", MATRIX),
        ("total_magnetization", T.DoubleType()),
        ("dos_ef", T.DoubleType()),
        ("charges", VECTOR),
        ("band_gap_indirect", T.DoubleType()),
        ("functional", T.StringType()),
        ("space_group_it_number", T.IntegerType()),
        ("cross_compatibility", T.BooleanType()),
        ("bawl_fingerprint", T.StringType()),
    ]
)

#: Trajectory frame table: a structure plus its place in the relaxation.
FRAME = T.StructType(
    STRUCTURE.fields
    + [
        T.StructField("relaxation_step", T.IntegerType()),
        T.StructField("relaxation_number", T.IntegerType()),
    ]
)

#: Version ledger: one row per synced dataset.
LEDGER = _fields(
    [
        ("dataset_name", T.StringType()),
        ("last_synced_version", T.StringType()),
        ("last_sync_date", T.TimestampType()),
        ("sync_status", T.StringType()),
    ]
)

# --- documents ------------------------------------------------------------
STRUCTURE_DOC = _fields(
    [
        ("lattice", _fields([("matrix", MATRIX)])),
        (
            "sites",
            T.ArrayType(
                _fields(
                    [
                        (
                            "species",
                            T.ArrayType(_fields([("element", T.StringType()), ("occu", T.DoubleType())])),
                        ),
                        ("abc", VECTOR),
                        ("xyz", VECTOR),
                        ("properties", _fields([("magmom", T.DoubleType())])),
                    ]
                )
            ),
        ),
    ]
)
_DATE = _fields([("$date", T.StringType())])

MATERIAL_DOC = _fields(
    [
        ("material_id", T.StringType()),
        ("last_updated", _DATE),
        ("elements", T.ArrayType(T.StringType())),
        ("nelements", T.IntegerType()),
        ("composition_reduced", T.MapType(T.StringType(), T.DoubleType())),
        ("formula_anonymous", T.StringType()),
        ("structure", STRUCTURE_DOC),
        ("task_types", T.MapType(T.StringType(), T.StringType())),
        ("deprecated_tasks", T.ArrayType(T.StringType())),
        ("calc_types", T.MapType(T.StringType(), T.StringType())),
        ("builder_meta", _fields([("build_date", _DATE), ("license", T.StringType())])),
    ]
)

IONIC_STEP = _fields(
    [
        ("e_fr_energy", T.DoubleType()),
        ("forces", MATRIX),
        ("stress", MATRIX),
        ("structure", STRUCTURE_DOC),
        # only the number of electronic steps matters
        ("electronic_steps", T.ArrayType(T.StringType())),
    ]
)

TASK_DOC = _fields(
    [
        ("task_id", T.StringType()),
        ("task_type", T.StringType()),
        ("nsites", T.IntegerType()),
        ("last_updated", _DATE),
        ("composition_reduced", T.MapType(T.StringType(), T.DoubleType())),
        ("elements", T.ArrayType(T.StringType())),
        ("nelements", T.IntegerType()),
        ("formula_anonymous", T.StringType()),
        (
            "input",
            _fields(
                [
                    (
                        "parameters",
                        _fields(
                            [
                                ("NELM", T.IntegerType()),
                                ("LASPH", T.BooleanType()),
                                ("ISPIN", T.IntegerType()),
                            ]
                        ),
                    )
                ]
            ),
        ),
        (
            "output",
            _fields(
                [
                    ("energy", T.DoubleType()),
                    ("forces", MATRIX),
                    ("stress", MATRIX),
                    ("bandgap", T.DoubleType()),
                    ("efermi", T.DoubleType()),
                    ("magnetization", _fields([("total_magnetization", T.DoubleType())])),
                    ("structure", STRUCTURE_DOC),
                ]
            ),
        ),
        (
            "calcs_reversed",
            T.ArrayType(_fields([("output", _fields([("ionic_steps", T.ArrayType(IONIC_STEP))]))])),
        ),
    ]
)

#: Payload of a keyed trajectory file: the relaxations of one material.
RELAXATIONS_DOC = T.ArrayType(
    _fields(
        [
            ("functional", T.StringType()),
            (
                "steps",
                T.ArrayType(
                    _fields(
                        [
                            ("structure", STRUCTURE_DOC),
                            ("energy", T.DoubleType()),
                            ("forces", MATRIX),
                            ("stress", MATRIX),
                        ]
                    )
                ),
            ),
        ]
    )
)

# --- fixed values: vendor document keys -> curated columns ----------------
VENDOR_BASE_KEYS = [
    "immutable_id",
    "chemical_formula_reduced",
    "chemical_formula_anonymous",
    "chemical_formula_descriptive",
    "cartesian_site_positions",
    "elements",
    "elements_ratios",
    "nelements",
    "nsites",
    "species_at_sites",
    "species",
    "nperiodic_dimensions",
    "dimension_types",
    "last_modified",
    "lattice_vectors",
]
#: suffix after the vendor prefix -> curated column
VENDOR_TARGET_KEYS = {
    "forces": "forces",
    "stress_tensor": "stress_tensor",
    "dos_ef": "dos_ef",
    "energy": "energy",
    "energy_corrected": "energy_corrected",
    "magnetic_moments": "magnetic_moments",
    "magnetization": "total_magnetization",
    "charges": "charges",
    "band_gap": "band_gap_indirect",
}
VENDOR_PREFIX = "_alexandria_"
VENDOR_SCAN_PREFIX = "_alexandria_scan_"
VENDOR_FUNCTIONAL_KEY = "_alexandria_xc_functional"


def dump_tables() -> dict[str, T.StructType]:
    """Schemas of the four relational snapshot tables."""
    lng, dbl, txt, num = T.LongType(), T.DoubleType(), T.StringType(), T.IntegerType()
    lattice = [(f"{axis}{row}", dbl) for row in (1, 2, 3) for axis in "xyz"]
    stress = [(name, dbl) for name in ("sxx", "syy", "szz", "syz", "szx", "sxy")]
    return {
        "entries": _fields([("id", lng)]),
        "structures": _fields(
            [
                ("id", lng),
                ("entry_id", lng),
                ("composition_id", txt),
                ("nsites", num),
                ("ntypes", num),
                ("magmom", dbl),
                ("energy", dbl),
            ]
            + lattice
            + stress
        ),
        "calculations": _fields(
            [
                ("entry_id", lng),
                ("label", txt),
                ("energy", dbl),
                ("energy_pa", dbl),
                ("band_gap", dbl),
                ("settings", txt),
                ("input_id", lng),
                ("output_id", lng),
                ("nsteps", num),
                ("converged", T.BooleanType()),
            ]
        ),
        "atoms": _fields(
            [("id", lng), ("structure_id", lng), ("element_id", txt)]
            + [(name, dbl) for name in ("x", "y", "z", "fx", "fy", "fz", "charge")]
        ),
    }
