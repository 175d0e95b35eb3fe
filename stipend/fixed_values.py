"""Constants the published files and payouts depend on.

They are data, not logic: column lists, wage types, file names, dictionary pairs and band steps
that have to keep exactly these values for results to be right.
"""

# Columns of a payroll record, in the order they are published.
RECORD_COLUMNS = [
    "PERNR", "LGART", "BEGDA", "ANZHL", "PTZEINH", "BETRG", "WAERS", "ESTDT", "ZUORD",
    "DATUM", "ZUTIMER", "ZSTAT", "ZFPROC", "ZUTIME", "ZUPROC", "ZDESCST", "ZINFOTIPO",
]
TWO_DECIMAL_COLUMNS = ["ANZHL", "BETRG"]
INTEGER_COLUMNS = ["ZINFOTIPO"]

# Status of a record that was not processed yet.
OPEN_STATUS = "N"

# Publication profiles: name, wage type (None = all), strict, rows per file, separator,
# two-decimal format, file prefix, file extension.
PROFILES = [
    ("base", "118A", True, 10000, ",", False, "ReplicaICMVS-VentaCerveza", "txt"),
    ("categoria", "115K", True, 10000, ";", True, "ReplicaICMVS-Categoria", "txt"),
    ("cerveza", "118A", True, 10000, ";", True, "ReplicaICMVS-VentaCerveza", "txt"),
    ("fijo", "110F", False, 10000, ";", False, "ReplicaICMVS-Fijo", "txt"),
    ("premia", "118B", False, 10000, ";", False, "ReplicaICMVS-Premia", "txt"),
    ("spin_cierre", "1766", False, 10000, ";", False, "ReplicaICMVS-SpinCierre", "txt"),
    ("sugerida", "112W", False, 10000, ";", True, "ReplicaICMVS-Sugerida", "txt"),
    ("variable", "116W", False, 10000, ";", False, "ReplicaICMVS-Variable", "txt"),
    ("it15", None, True, 8000, ";", True, "ReplicaICMEP", "csv"),
]

# Growth bands over an inflation rate: first band ends one unit below the rate, five bands of one
# step follow, the last one is open up to the ceiling.
BAND_UNIT = "0.0001"
BAND_STEP = "0.0100"
BAND_WIDTH = "0.0099"
BAND_CEILING = "2000.0000"
STEPPED_BANDS = 5

# Store focus letters and their codes; any other letter, or none, is 0.
FOCUS_CODES = {"E": 1, "I": 2, "C": 3, "D": 4}

# Area used when an employee has none, per role tag.
DEFAULT_AREA = {"L": "NP", "EA": "NP", "EB": "3781"}

# Dataset families published under a fixed name, and the marker file written next to them.
SNAPSHOT_FAMILIES = ["XXICMSALDOS2", "XXICMCONSOLIDADOCOMISIONES", "XXICMCOMISIONES"]
SNAPSHOT_MARKER = "OK.txt"

# Suffix of a recoded copy.
RECODED_SUFFIX = "_LIMPIO.csv"

# Whole-cell replacements, in order: first places, then divisions.
PLACE_NAMES = [
    ("10DCU Humaya", "10DCU Culiacan Sur"),
    ("10DCU Culiacan", "10DCU Culiacan Norte"),
    ("10DCU Manzanillo", "10DCU Tepic Centro"),
    ("10GUD Chapala", "10GUD Tlajomulco"),
    ("10GUD Tlaquepaque", "10GUD GDL Poniente"),
    ("10GUD Tepic", "10GUD GDL Oriente"),
    ("10CAN Chichen Itza", "10CAN Merida"),
    ("10CAN Kukulkan", "10CAN Cancun"),
    ("10CAN Xcaret", "10CAN PlayaDelCarmen"),
    ("10CAN Uxmal", "10CAN Campeche"),
    ("10TLC Tol Zitacuaro", "10TLC Toluca Norte"),
    ("10TLC Toluca Nevado", "10TLC Toluca Sur"),
    ("10GTO Aguascalientes", "10GTO Ags Norte"),
    ("10GTO Guanajuato Ags", "10GTO Ags Sur"),
    ("10GTO Leon", "10GTO Leon Norte"),
    ("10GTO Guanajuato Sur", "10GTO Irapuato"),
    ("10MXL Sonora Norte", "10MXL San Luis RC"),
]
DIVISION_NAMES = [
    ("OXX GUADALAJARA CHAPALA", "OXXO TLAJOMULCO"),
    ("OXX GUADALAJARA TLAQUEPAQUE", "OXXO GUADALAJARA PONIENTE"),
    ("OXX TEPIC", "OXXO GUADALAJARA ORIENTE"),
    ("Oxxo Humaya", "OXXO CULIACAN SUR"),
    ("Oxxo Culiacan", "OXXO CULIACAN NORTE"),
    ("Oxxo Manzanillo", "OXXO TEPIC CENTRO"),
    ("OXXO GUADALAJARA CHAPALA II", "OXXO TLAJOMULCO II"),
    ("OXXO MANZANILLO II", "OXXO TEPIC CENTRO II"),
    ("OXXO MANZANILLO", "OXXO TEPIC CENTRO"),
    ("OXXO HUMAYA", "OXXO CULIACAN SUR"),
    ("OXXO CULIACAN", "OXXO CULIACAN NORTE"),
]

# Interchange files of the payout job: file name, then columns in file order as
# (name in the file, name used here, Spark type). An empty name marks a column that is not used.
PAYOUT_FILES = {
    "inflation": ("zMTVINFLACION.csv", [
        ("INFLACION", "rate", "decimal(14,4)"), ("BEGDA", "begda", "date"),
        ("ENDDA", "endda", "date"), ("EffStart", "", "date"), ("EffEnd", "", "date"),
    ]),
    "sales": ("VTA_TDA_MULTI.csv", [
        ("IDSTORE", "store", "string"), ("FECHA", "sale_date", "date"),
        ("VTACONTABLE", "amount", "decimal(14,2)"), ("TRAFICO", "", "string"),
        ("IDSTATUS", "status", "int"),
    ]),
    "focus": ("ENFOQUE_TDA.csv", [
        ("TIENDA", "store", "string"), ("ENFOQUE", "focus", "string"),
        ("BEGDA", "begda", "date"), ("ENDDA", "", "date"),
    ]),
    "tariff": ("TABULADORES_DESEMPEÑO.csv", [
        ("CASOTABULADOR", "case_id", "int"), ("ENFOQUE", "focus", "int"), ("RANGO", "band", "int"),
        ("PAGOLIDER", "pay_leader", "decimal(14,2)"),
        ("PAGOENCARGADO", "pay_manager", "decimal(14,2)"),
        ("PAGOLIDERENFOQUE", "pay_leader_focus", "decimal(14,2)"),
    ]),
    "absence_types": ("CfgAbsences.csv", [
        ("IDAbsence", "type", "string"), ("Descripcion", "", "string"), ("IDStatus", "status", "int"),
    ]),
    "pairs": ("VALIDACION_VARIABLE.csv", [
        ("CASOTABULADOR", "case_id", "int"), ("CRPLAZAA", "", "string"),
        ("CRTIENDAA", "", "string"), ("TDAA", "store_a", "string"), ("CRPLAZAB", "", "string"),
        ("CRTIENDAB", "", "string"), ("TDAB", "store_b", "string"), ("BEGDA", "begda", "date"),
        ("ENDDA", "endda", "date"), ("LGART", "wage_type", "string"), ("IDS", "ids", "int"),
        ("DESERROR", "", "string"), ("DateInsert", "", "date"),
    ]),
    "history": ("HistoryPayee.csv", [
        ("PayeeID", "payee", "string"), ("Parent", "", "string"), ("TitleID", "", "string"),
        ("ReportsTo", "", "string"), ("DateStart", "date_start", "date"),
        ("DateEnd", "date_end", "date"), ("IDOrganizationalUnit", "", "string"),
        ("IDSociety", "", "string"), ("IDPersonalDivision", "", "string"),
        ("IDPersonalSubdivision", "", "string"), ("IDEEGroup", "", "string"),
        ("IDPersonalArea", "area", "string"), ("IDPayrollArea", "", "string"),
        ("IDPosition", "", "string"), ("IDJobKey", "", "string"), ("IDCostCenter", "", "string"),
        ("IDAuxiliaryCeco", "", "string"), ("IDStore", "store", "string"),
        ("IDRole", "role", "string"), ("DateInsertion", "", "string"),
        ("EffStart", "", "date"), ("EffEnd", "", "date"), ("IDStatus", "status", "int"),
    ]),
    "absences": ("HistoryAbsences.csv", [
        ("EMPLEADO", "payee", "string"), ("FECHAINICIO", "start_date", "date"),
        ("DIAS", "days", "int"),
    ]),
}

# Columns of the payout detail: name used here, then the published name, in published order.
PAYOUT_COLUMNS = [
    ("store_a", "TDAA"), ("store_b", "TDAB"), ("begda", "BEGDA"), ("endda", "ENDDA"),
    ("wage_type", "LGART"), ("sales", "VATDAB"), ("prior_sales", "VVTDAB"),
    ("growth", "Incremento"), ("case_id", "CASOTABULADOR"), ("band", "RANGOB"),
    ("focus_a", "EnfoqueA"), ("focus_b", "EnfoqueB"), ("pay_manager_b", "PAGOENCARGADOB"),
    ("pay_leader_sales_b", "PAGOLIDERBVTA"), ("pay_leader_focus_b", "PAGOLIDERBEFQ"),
    ("pay_manager_a", "PAGOENCARGADOA"), ("payee", "PayeeID"), ("role", "Rol"), ("days", "D"),
    ("month_days", "M"), ("date_start", "DateStart"), ("date_end", "DateEnd"),
    ("share", "Proportional"), ("pay", "PAGOSAP"), ("area", "IDPA"),
    ("absence_days", "AUSENTISMOS"), ("absence_pay", "PTRESTAR"), ("final_pay", "PAGOFINAL"),
]
PAYOUT_FILE = "SALIDA_DETALLEEXPORT.csv"
