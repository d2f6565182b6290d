"""Code lists and label maps.

FIXED VALUES — these must equal the published code books of the feeds for
loads to produce the right keys.  They are stated plainly, in natural order,
and used only as data (literal DataFrames or ``create_map`` literals).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: canonical transport modes (name, feeds that report it).
# Surrogate ids are 1..15 in this order.
# ---------------------------------------------------------------------------
CANONICAL_MODES = [
    ("Truck", "both"),
    ("Rail", "both"),
    ("Rail (legacy code 2)", "transborder"),
    ("Personal Vehicle", "border_crossing"),
    ("Personal Vehicle Passenger", "border_crossing"),
    ("Pedestrian", "border_crossing"),
    ("Bus", "border_crossing"),
    ("Bus Passenger", "border_crossing"),
    ("Train Passenger", "border_crossing"),
    ("Air", "transborder"),
    ("Vessel", "transborder"),
    ("Pipeline", "transborder"),
    ("Foreign Trade Zone", "transborder"),
    ("Mail", "transborder"),
    ("Other", "transborder"),
]

# FIXED VALUES: national trade feed mode code (DISAGMOT) -> canonical mode.
TRADE_MODE_CODE_TO_MODE = {
    1: "Vessel",
    2: "Rail (legacy code 2)",
    3: "Air",
    4: "Mail",
    5: "Truck",
    6: "Rail",
    7: "Pipeline",
    8: "Other",
    9: "Foreign Trade Zone",
}

# FIXED VALUES: trade type code -> direction.
TRADE_TYPE_TO_DIRECTION = {1: "Export", 2: "Import"}

# FIXED VALUES: container code -> container label (anything else -> Unknown).
CONTAINER_CODE_TO_LABEL = {"0": "Not Containerized", "1": "Containerized", "X": "Unknown"}

# FIXED VALUES: origin flag -> production location (NULL or other -> N/A).
ORIGIN_FLAG_TO_LOCATION = {1.0: "Domestically Produced Goods", 2.0: "Foreign Produced Goods"}

# FIXED VALUES: mirror feed mode text -> canonical mode.
MIRROR_MODE_TO_MODE = {
    "Truck": "Truck",
    "Rail": "Rail",
    "Air": "Air",
    "Vessel": "Vessel",
    "Pipeline": "Pipeline",
    "Foreign Trade Zones (FTZs)": "Foreign Trade Zone",
    "Mail (U.S. Postal Service)": "Mail",
    "Other": "Other",
}

# FIXED VALUES: crossing feed measure -> canonical mode.
CROSSING_MEASURE_TO_MODE = {
    "Trucks": "Truck",
    "Trains": "Rail",
    "Personal Vehicles": "Personal Vehicle",
    "Personal Vehicle Passengers": "Personal Vehicle Passenger",
    "Pedestrians": "Pedestrian",
    "Buses": "Bus",
    "Bus Passengers": "Bus Passenger",
    "Train Passengers": "Train Passenger",
}

# FIXED VALUES: lane types (name, vehicle category, trusted-traveler flag).
# Surrogate ids are 1..6 in this order.
LANE_TYPES = [
    ("Commercial Fast", "Commercial", True),
    ("Commercial Standard", "Commercial", False),
    ("POV Standard", "POV", False),
    ("POV NEXUS/SENTRI", "POV", True),
    ("Pedestrian Standard", "Pedestrian", False),
    ("Pedestrian Ready", "Pedestrian", True),
]

# FIXED VALUES: wait feed lane text -> canonical lane.
WAIT_LANE_TO_LANE = {
    "Commercial_Fast_Lane": "Commercial Fast",
    "Commercial_Standard_Lane": "Commercial Standard",
    "Passenger_vehicle_Standard_Lane": "POV Standard",
    "Passenger_vehicle_NEXUS_SENTRI_Lane": "POV NEXUS/SENTRI",
    "Pedestrian_standard_Lane": "Pedestrian Standard",
    "Pedestrian_Ready_Lanes": "Pedestrian Ready",
}

# FIXED VALUES: wait feed port text -> canonical port name.
WAIT_PORT_TO_PORT = {
    "Calexico_East": "Calexico East",
    "Calexico_West": "Calexico",
    "Otay Mesa": "Otay Mesa",
    "San Ysidro": "San Ysidro",
    "Tecate": "Tecate",
    "Andrade": "Andrade",
}

# FIXED VALUES: customs district -> state for discovered aggregate members.
DISTRICT_TO_STATE = {23: "Texas", 24: "Texas", 25: "California", 26: "Arizona"}
DEFAULT_STATE = "Other"

# FIXED VALUES: scope filters of the crossing feed.
CROSSING_BORDER = "US-Mexico Border"
CROSSING_EXCLUDED_PORT = "Cross Border Xpress"
TRADE_COUNTRY_CODE = 2010

# FIXED VALUES: data source tags of the trade fact.
SOURCE_NATIONAL = "national"
SOURCE_MIRROR = "mirror"

# FIXED VALUES: expected row-count bands of the dimensions (check name, low, high).
DIM_COUNT_BANDS = [
    ("corridor_ports", 3, 3),
    ("commodity_chapters", 95, 99),
    ("calendar_days", 10001, 11999),
    ("modes", 15, 15),
    ("lane_types", 6, 6),
]


def mode_ids() -> dict[str, int]:
    """Canonical mode name -> surrogate id (1-based catalog order)."""
    return {name: i + 1 for i, (name, _) in enumerate(CANONICAL_MODES)}


def lane_ids() -> dict[str, int]:
    return {name: i + 1 for i, (name, _, _) in enumerate(LANE_TYPES)}

# ---------------------------------------------------------------------------
# FIXED VALUES: HS two-digit chapters (code, full description as published in
# the trade feed, sector group).  Chapter 77 is reserved and absent.  The full
# description is also the anchor for matching the mirror feed's commodity
# text after ``normalize_text``.
# ---------------------------------------------------------------------------
HS2_CHAPTERS = [
    (1, "Live animals", "Agro/Alimentos"),
    (2, "Meat and edible meat offal", "Agro/Alimentos"),
    (3, "Fish and crustaceans, mollusks and other aquatic invertebrates", "Agro/Alimentos"),
    (4, "Dairy produce; Birds' eggs; Natural honey; Edible products of animal origin, not elsewhere specified or included", "Agro/Alimentos"),
    (5, "Products of animal origin, not elsewhere specified or included", "Agro/Alimentos"),
    (6, "Live trees and other plants; Bulbs, roots and the like; Cut flowers and ornamental foliage", "Agro/Alimentos"),
    (7, "Edible vegetables and certain roots and tubers", "Agro/Alimentos"),
    (8, "Edible fruit and nuts; Peel of citrus fruit or melons", "Agro/Alimentos"),
    (9, "Coffee, tea, mate and spices", "Agro/Alimentos"),
    (10, "Cereals", "Agro/Alimentos"),
    (11, "Products of the milling industry; Malt; Starches; inulin; Wheat gluten", "Agro/Alimentos"),
    (12, "Oil seeds and oleaginous fruits; Miscellaneous grains; Seeds and fruit; Industrial or medicinal plants; Straw and fodder", "Agro/Alimentos"),
    (13, "Lac; Gums; Resins and other vegetable saps and extract", "Agro/Alimentos"),
    (14, "Vegetable plaiting materials; Vegetable products not elsewhere specified or included", "Agro/Alimentos"),
    (15, "Animal or vegetable fats and oils and their cleavage products; Prepared edible fats; Animal or vegetable waxes", "Agro/Alimentos"),
    (16, "Preparations of meat, of fish, or of crustaceans, mollusks or other aquatic invertebrates", "Agro/Alimentos"),
    (17, "Sugars and sugar confectionery", "Agro/Alimentos"),
    (18, "Cocoa and cocoa preparations", "Agro/Alimentos"),
    (19, "Preparations of cereals, flour, starch or milk; Bakers' wares", "Agro/Alimentos"),
    (20, "Preparations of vegetables, fruit, nuts, or other parts of plants", "Agro/Alimentos"),
    (21, "Miscellaneous edible preparations", "Agro/Alimentos"),
    (22, "Beverages, spirits and vinegar", "Agro/Alimentos"),
    (23, "Residues and waste from the food industries; Prepared animal feed", "Agro/Alimentos"),
    (24, "Tobacco and manufactured tobacco substitutes", "Agro/Alimentos"),
    (25, "Salt; Sulfur; Earths and stone; Plastering materials, lime and cement", "Energía/Minerales"),
    (26, "Ores, slag and ash", "Energía/Minerales"),
    (27, "Mineral fuels, mineral oils and products of their distillation; Bituminous substances; Mineral waxes", "Energía/Minerales"),
    (28, "Inorganic chemicals; Organic or inorganic compounds of precious metals, of rare-earth metals, of radioactive elements or of isotopes", "Química/Cuero"),
    (29, "Organic chemicals", "Química/Cuero"),
    (30, "Pharmaceutical products", "Médico/Precisión"),
    (31, "Fertilizers", "Química/Cuero"),
    (32, "Tanning or dyeing extracts; Tannins and their derivatives; Dyes, pigments and other coloring matter; Paints and varnishes; Putty and other mastics; Inks", "Química/Cuero"),
    (33, "Essential oils and resinoids; Perfumery, cosmetic or toilet preparations", "Química/Cuero"),
    (34, "Soap, organic surface-active agents, washing preparations, lubricating preparations, artificial waxes, prepared waxes, polishing or scouring preparations, candles and similar articles, modeling pastes, dental waxes and dental preparations with a basis of plaster", "Química/Cuero"),
    (35, "Albuminoidal substances; Modified starches; Glues; Enzymes", "Química/Cuero"),
    (36, "Explosives; Pyrotechnic products; Matches; Pyrophoric alloys; Certain combustible preparations", "Química/Cuero"),
    (37, "Photographic or cinematographic goods", "Química/Cuero"),
    (38, "Miscellaneous chemical products", "Química/Cuero"),
    (39, "Plastics and articles thereof", "Plásticos/Caucho"),
    (40, "Rubber and articles thereof", "Plásticos/Caucho"),
    (41, "Raw hides and skins (other than furskins) and leather", "Química/Cuero"),
    (42, "Articles of leather; Saddlery and harness; Travel goods, handbags and similar containers; Articles of animal gut (other than silkworm gut)", "Química/Cuero"),
    (43, "Furskins and artificial fur; Manufactures thereof", "Química/Cuero"),
    (44, "Wood and articles of wood; Wood charcoal", "Madera/Papel"),
    (45, "Cork and articles of cork", "Madera/Papel"),
    (46, "Manufactures of straw, of esparto or of other plaiting materials; Basketware and wickerwork", "Madera/Papel"),
    (47, "Pulp of wood or of other fibrous cellulosic material; Waste and scrap of paper or paperboard", "Madera/Papel"),
    (48, "Paper and paperboard; Articles of paper pulp, of paper or of paperboard", "Madera/Papel"),
    (49, "Printed books, newspapers, pictures and other products of the printing industry; Manuscripts, typescripts and plans", "Madera/Papel"),
    (50, "Silk", "Textil/Calzado"),
    (51, "Wool, fine or coarse animal hair; Horsehair yarn and woven fabric", "Textil/Calzado"),
    (52, "Cotton", "Textil/Calzado"),
    (53, "Other vegetable textile fibers; Paper yarn and woven fabrics of paper yarn", "Textil/Calzado"),
    (54, "Man-made filaments", "Textil/Calzado"),
    (55, "Man-made staple fibers", "Textil/Calzado"),
    (56, "Wadding, felt and nonwovens; Special yarns; Twine, cordage, ropes and cables and articles thereof", "Textil/Calzado"),
    (57, "Carpets and other textile floor coverings", "Textil/Calzado"),
    (58, "Special woven fabrics; Tuffed textile fabrics; Lace; Tapestries; Trimmings; Embroidery", "Textil/Calzado"),
    (59, "Impregnated, coated, covered or laminated textile fabrics; Textile articles of a kind suitable for industrial use", "Textil/Calzado"),
    (60, "Knitted or crocheted fabrics", "Textil/Calzado"),
    (61, "Articles of apparel and clothing accessories, knitted or crocheted", "Textil/Calzado"),
    (62, "Articles of apparel and clothing accessories, not knitted or crocheted", "Textil/Calzado"),
    (63, "Other made-up textile articles; Needle craft sets; Worn clothing and worn textile articles; rags", "Textil/Calzado"),
    (64, "Footwear, gaiters and the like; Parts of such articles", "Textil/Calzado"),
    (65, "Headgear and parts thereof", "Textil/Calzado"),
    (66, "Umbrellas, sun umbrellas, walking sticks, seatsticks, whips, riding crops and parts thereof", "Textil/Calzado"),
    (67, "Prepared feathers and down and articles made of feathers or of down; artificial flowers; articles of human hair", "Textil/Calzado"),
    (68, "Articles of stone, plaster, cement, asbestos, mica or similar materials", "Construcción"),
    (69, "Ceramic products", "Construcción"),
    (70, "Glass and glassware", "Construcción"),
    (71, "Natural or cultured pearls, precious or semiprevious stones, precious metals; metals clad with precious metal, and articles thereof; imitation jewelry; coin", "Energía/Minerales"),
    (72, "Iron and steel", "Metales"),
    (73, "Articles of iron or steel", "Metales"),
    (74, "Copper and articles thereof", "Metales"),
    (75, "Nickel and articles thereof", "Metales"),
    (76, "Aluminum and articles thereof", "Metales"),
    (78, "Lead and articles thereof", "Metales"),
    (79, "Zinc and articles thereof", "Metales"),
    (80, "Tin and articles thereof", "Metales"),
    (81, "Other base metals; Cermets; Articles thereof", "Metales"),
    (82, "Tools, implements, cutlery, spoons and forks, of base metal; Parts thereof of base metal", "Metales"),
    (83, "Miscellaneous articles of base metal", "Metales"),
    (84, "Nuclear reactors, boilers, machinery and mechanical appliances; parts thereof", "Electrónica/Maquinaria"),
    (85, "Electrical machinery and equipment and parts thereof; Sound recorders and reproducers, television image and sound recorders and reproducers, and parts and accessories of such articles", "Electrónica/Maquinaria"),
    (86, "Railway or tramway locomotives, rolling stock and parts thereof; railway or tramway track fixtures and fittings and parts thereof; Mechanical (including electromechanical) traffic signaling equipment of all kinds", "Automotriz"),
    (87, "Vehicles, other than railway or tramway rolling stock, and parts and accessories thereof", "Automotriz"),
    (88, "Aircraft, spacecraft, and parts thereof", "Otros"),
    (89, "Ships, boats, and floating structures", "Otros"),
    (90, "Optical, photographic, cinematographic, measuring, checking, precision, medical or surgical instruments and apparatus; Parts and accessories thereof", "Médico/Precisión"),
    (91, "Clocks and watches and parts thereof", "Otros"),
    (92, "Musical instruments; Parts and accessories of such articles", "Otros"),
    (93, "Arms and ammunition; Parts and accessories thereof", "Otros"),
    (94, "Furniture; Bedding, mattress supports, cushions and similar stuffed furnishings; Lamps and lighting fittings, not elsewhere specified or included; Illuminated signs, illuminated nameplates and the like; Prefabricated buildings", "Manufacturas varias"),
    (95, "Toys, games and sports equipment; Parts and accessories thereof", "Manufacturas varias"),
    (96, "Miscellaneous manufactured articles", "Manufacturas varias"),
    (97, "Works of art, collectors' pieces and antiques", "Otros"),
    (98, "Special classification provisions", "Otros"),
]

# FIXED VALUES: corridor ports of the study (canonical names).
CORRIDOR_PORTS = ("San Ysidro", "Otay Mesa", "Tecate")
