"""Fixed values of the inventory semantics.

Every list in this file is data that decides results: patterns, labels, alias
names, path guesses and limits. Lists are in their meaningful order; where the
first match wins, the order is part of the semantics.
"""

# --- fixed values: host / CNAME signatures, first match wins -----------------
HOST_SIGNATURES = [
    (r"dealercenterwebsite\.net|dealercenter\.net", "DealerCenter"),
    (r"mycarsonline\.com", "DealerCarSearch"),
    (r"v12soft\.com", "V12Software"),
    (r"godealergo\.com", "DealerGo"),
    (r"theshopclubs\.com", "ShopClubs"),
    (r"dealeron\.com", "DealerOn"),
    (r"dealerinspire\.com", "DealerInspire"),
    (r"dealer\.com|edgepilot|ddc\.com", "Dealer.com"),
    (r"wixsite\.com|wix\.com", "Wix"),
    (r"facebook\.com", "Facebook (sin inventario)"),
]

# --- fixed values: page signatures, first match wins --------------------------
HTML_SIGNATURES = [
    (r"dws-vehicle|dealercenter", "DealerCenter"),
    (r'ws-inv-data|data-widget-name|ddc\.com|"dealer\.com"', "Dealer.com"),
    (r"dealerinspire|di-cta|cms-content-di", "DealerInspire"),
    (r"dealeron|do-app|dealeroncdn", "DealerOn"),
    (r"mycarsonline|dealercarsearch", "DealerCarSearch"),
    (r"v12soft|v12software", "V12Software"),
    (r"motorlot", "MotorLot"),
    (r"dealersync", "DealerSync"),
    (r"overfuel", "OverFuel"),
    (r"dealrcloud|dealrimages|dealr\.cloud", "Dealr.cloud"),
    (r"carsforsale\.com", "CarsForSale.com"),
    (r"goxee", "GoxeeDealer"),
    (r"frazer", "Frazer"),
    (r"cdn-website\.com|dudaone|duda\.co", "Duda (constructor)"),
    (r"captcha-delivery\.com|datadome", "DataDome (anti-bot)"),
    (r"wsimg\.com|secureserver|starfield|godaddysites", "GoDaddy (constructor)"),
    (r"automanager\.com|deskmanager", "AutoManager"),
    (r"autorevo", "AutoRevo"),
    (r"dealerfire", "DealerFire"),
    (r"autocorner\.com", "AutoCorner"),
    (r"hugedomains|godaddy.*parked|domain.*for sale|expireddomains", "PARQUEADO (en venta)"),
    (r"wp-content|wp-json|wordpress", "WordPress (genérico)"),
    (r"wix\.com|_wixCssImports", "Wix"),
    (r"squarespace", "Squarespace"),
    (r"shopify", "Shopify"),
]

# --- fixed values: site-builder tests, plain substrings of the lowered page ----
BUILDER_MARKERS = [
    (("dealer.com", "ddc-"), "dealer.com"),
    (("dealeron",), "dealeron"),
    (("dealerinspire", "dealer inspire"), "dealerinspire"),
    (("dealersocket",), "dealersocket"),
    (("carsforsale.com",), "carsforsale"),
    (("wp-content", "wp-json"), "wordpress"),
    (("__next_data__",), "nextjs"),
    (("window.__nuxt__",), "nuxt"),
    (("shopify",), "shopify"),
]

# --- fixed values: labels ------------------------------------------------------
LABEL_UNKNOWN = "DESCONOCIDA (custom)"
LABEL_UNREACHABLE = "INALCANZABLE"
LABEL_CHECK_WITH_BROWSER = "BLOQUEADA/CAÍDA (revisar c/navegador)"
LABEL_DATADOME = "DataDome (anti-bot)"
LABEL_PARKED = "PARQUEADO (en venta)"
BLOCKED_LABELS = [LABEL_DATADOME, LABEL_UNREACHABLE, LABEL_CHECK_WITH_BROWSER]
INCONCLUSIVE_LABELS = [LABEL_DATADOME, LABEL_UNREACHABLE]
READY_LABELS = [
    "DealerCenter", "DealerCarSearch", "DealerSync", "Dealr.cloud", "OverFuel",
    "DealerInspire",
]
KNOWN_PENDING_LABELS = [
    "Dealer.com", "GoxeeDealer", "MotorLot", "V12Software", "Frazer", "DealerOn",
    "DealerGo", "ShopClubs", "CarsForSale.com", "AutoManager", "AutoRevo",
    "DealerFire", "AutoCorner",
]
LAYER_ORDER = [
    "L0_extractor", "L0_pendiente", "L1_api", "L2_embebido", "L3_navegacion",
    "antibot", "recuperable", "descartado",
]
SEED_TAGS = [
    "DealerCenter", "DealerCarSearch", "DealerSync", "Dealr.cloud", "OverFuel",
    "DealerInspire", "Dealer.com", "CarsForSale.com",
]
# platform label -> extractor
EXTRACTOR_BY_LABEL = {
    "DealerCenter": "dws",
    "DealerCarSearch": "dws",
    "dws": "dws",
    "DealerSync": "dealersync",
    "dealersync": "dealersync",
    "Dealr.cloud": "dealr",
    "dealr": "dealr",
    "OverFuel": "overfuel",
    "overfuel": "overfuel",
    "DealerInspire": "dealerinspire",
    "dealerinspire": "dealerinspire",
    "Dealer.com": "dealercom",
    "dealercom": "dealercom",
    "CarsForSale.com": "carsforsale",
    "carsforsale": "carsforsale",
}

# --- fixed values: blocked / challenge / parked page tests ----------------------
BLOCKED_STATUS = [403, 429, 503]
BLOCKED_MARKERS = (
    r"just a moment|checking your browser|cf-browser-verification|cf-challenge"
    r"|captcha-delivery\.com|datadome|geo\.captcha-delivery"
    r"|enable javascript and cookies to continue|attention required.*cloudflare"
    r"|access denied|are you a human"
)
CHALLENGE_MARKERS = (
    r"just a moment|captcha-delivery|datadome|checking your browser"
    r"|attention required|enable javascript and cookies|access denied"
)
PARKED_MARKERS = r"hugedomains|domain.*for sale|buy this domain|parked"
RENDERED_VEHICLE_MARKERS = (
    r'data-vin|"vin"|vehicleIdentificationNumber|dws-vehicle|ds-vehicle'
    r"|dealr-inventory|srp-card"
)
SPA_MARKERS = (
    r"\{\{|ng-repeat|v-for|__NUXT__|__NEXT_DATA__|vehicleDetailUrl|/_content/|data-react"
)
DETAIL_LINK = r"/(details|vehicle|inventory|vdp)/"
STATE_MARKERS_CASED = r"__NEXT_DATA__|__NUXT__|__INITIAL_STATE__|__PRELOADED_STATE__"
STATE_VIN_WORDS = r'"vin"|vehicleIdentificationNumber|"inventory"'
STATE_SCRIPT = r"__INITIAL_STATE__|__NUXT__|__PRELOADED_STATE__|window\.inventory|var\s+inventory"
LD_INVENTORY_TYPE = r"vehicle|car|product"
VENDOR_NOISE = (
    r"google|gstatic|jquery|cloudflare|cloudfront|fonts|facebook|gtag|youtube"
    r"|bootstrapcdn|jsdelivr|gravatar|w3\.org|googleapis|cdnjs|recaptcha|doubleclick"
    r"|googletag|fbcdn|instagram|twitter|linkedin|bing|googleadservices|ampproject"
    r"|gstatic|tiktok|pinterest|hotjar|cargurus|kbb\.com|carfax|autocheck"
)

# --- fixed values: limits --------------------------------------------------------
MIN_PAGE_CHARS = 1_500
SPA_MIN_PAGE_CHARS = 2_000
SPA_BIG_PAGE_CHARS = 8_000
MAX_PAGES = 15
MAX_VEHICLES = 2_000
SHORT_PAGE = {"dealr": 50, "overfuel": 25, "carsforsale": 24}

# --- fixed values: paths ---------------------------------------------------------
INVENTORY_PATHS = [
    "/inventory", "/used-inventory", "/new-inventory", "/all-inventory",
    "/used-vehicles", "/used-cars", "/cars-for-sale", "/vehicles",
    "/inventario", "/vehiculos", "/usados", "/autos", "/searchused.aspx",
    "/used-vehicles-for-sale", "/VehicleSearchResults",
]
API_PATHS = [
    "/api/inventory", "/api/vehicles", "/api/inventory/search",
    "/apis/widget/INVENTORY_LISTING_DEFAULT_AUTO_ALL:inventory-data-bus1/getInventory",
    "/inventory.json", "/feed/inventory.json", "/api/v1/inventory",
    "/wp-json/wp/v2/inventory?per_page=100",
    "/api/search/inventory",
]
BUILDER_API_PATHS = {
    "dealer.com": [
        "/apis/widget/INVENTORY_LISTING_DEFAULT_AUTO_ALL:inventory-data-bus1/getInventory?start=0&pageSize=100",
    ],
    "wordpress": [
        "/wp-json/wp/v2/inventory?per_page=100",
        "/wp-json/wp/v2/vehicles?per_page=100",
    ],
    "dealerinspire": ["/api/inventory/search?per_page=100"],
}
QUOTED_API_PATH = (
    r"""["'](/[a-z0-9_\-/.]*(?:inventory|vehicles|inventario|vehiculos)[a-z0-9_\-/.?=&]*)["']"""
)
ASSET_PATH = r"\.(css|js|png|jpe?g|svg|webp|gif)(\?|$)"
ASSET_URL = r"\.(png|jpe?g|svg|woff)"
LINK_WORDS = [
    "inventory", "inventario", "used", "usados", "vehicles", "vehiculos",
    "vehículos", "cars for sale", "autos",
]
WIDE_LINK_HREF = (
    r"inventory|used-vehicles|used-cars|pre-owned|vehicles-for-sale|cars-for-sale|/srp|/vehicles"
)
WIDE_LINK_TEXT = r"invent|used|pre-owned|vehicle|cars"
ANCHOR_TEXT = {
    "dealersync": r"^(inventory|view inventory|pre-?owned|used|vehicles)",
    "dealr": r"^(inventory|view inventory|pre-?owned|used)",
}
DEALERCOM_URL = r"getInventory|inventory-data|ws-inv-data"
CARS_COMMERCE_URL = r"carscommerce.*/listings/\d+/search"

# --- fixed values: vehicle key words and aliases -----------------------------------
VEHICLE_KEY_WORDS = [
    "vin", "make", "model", "year", "mileage", "odometer", "stocknumber",
    "stock_number", "price", "trim",
]
FIELD_ALIASES = {
    "vin": ["vin", "vehicleidentificationnumber", "vin_number"],
    "stock_number": ["stocknumber", "stock_number", "stock", "stockno", "sku"],
    "make": ["make", "brand", "manufacturer", "marca"],
    "model": ["model", "modelo"],
    "trim": ["trim", "version", "vehicletrim", "serie"],
    "year": ["year", "modelyear", "vehicleyear", "anio", "año", "ano"],
    "mileage": ["mileage", "miles", "odometer", "odometro", "kilometraje", "km", "mileagevalue"],
    "price": ["price", "sellingprice", "saleprice", "internetprice", "listprice", "precio",
              "askingprice", "finalprice"],
    "msrp": ["msrp", "retailprice", "originalprice"],
    "exterior_color": ["exteriorcolor", "extcolor", "color", "colorexterior", "exterior_color",
                       "exteriorcolour"],
    "interior_color": ["interiorcolor", "intcolor", "colorinterior", "interior_color"],
    "transmission": ["transmission", "transmision", "gearbox", "transmissiontype"],
    "drivetrain": ["drivetrain", "drivetype", "traccion", "driveline"],
    "fuel_type": ["fueltype", "fuel", "combustible", "fuel_type"],
    "engine": ["engine", "enginedescription", "motor", "enginesize"],
    "body_style": ["bodystyle", "body", "bodytype", "carroceria", "vehicletype", "body_style"],
    "doors": ["doors", "numberofdoors", "puertas", "doorcount"],
    "condition": ["condition", "type", "newused", "inventorytype", "estado", "itemcondition"],
    "location": ["location", "dealership", "city", "localidad", "lot", "dealername", "address",
                 "sucursal"],
    "url": ["url", "link", "vdpurl", "detailurl", "vehicleurl", "href", "permalink"],
    "image_url": ["imageurl", "image", "photo", "thumbnail", "mainphoto", "primaryimage",
                  "images", "photourl"],
    "description": ["description", "comments", "descripcion", "sellersnotes"],
}
VIN_PATTERN = r"^[A-HJ-NPR-Z0-9]{17}$"
VIN_IN_TEXT = r"\b[A-HJ-NPR-Z0-9]{17}\b"
YEAR_MAKE_MODEL = r"\b(19[5-9]\d|20[0-4]\d)\s+([A-Z][A-Za-z-]+)\s+([A-Za-z0-9-]+)"
CARD_PRICE = r"\$\s?([\d,]{4,})"
CARD_MILES = r"(?i)([\d,]{1,7})\s*(?:miles|mi\.?|km|kil[oó]metros)"
VIN_LETTERS = "ABCDEFGHJKLMNPRSTUVWXYZ"

# --- fixed values: elements that may be a card, and how far up a VIN's card is sought ---
GENERIC_CARDS = {
    "classes": ("vehicle", "inventory", "srp-", "listing"),
    "tags": ("article",),
    "tag_classes": {"li": "result"},
}
WIDE_CARDS = {
    "classes": ("vehicle", "inventory", "srp", "listing", "card", "result", "item"),
    "tags": ("article", "li", "tr"),
    "tag_classes": {},
}
CARD_TEXT_CHARS = (20, 3000)
CARD_ANCESTORS = 6

# --- fixed values: HTML elements without an end tag, and end tags HTML lets out ---------
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr",
)
RAW_TEXT_TAGS = ("script", "style")
FOREIGN_TAGS = ("svg", "path", "circle", "rect", "use", "line", "polygon", "polyline", "g")
_TABLE = ("table", "template")
_BLOCK_ENDS_P = ((("p",), ("td", "th", "caption", "button", "object", "table")),)
IMPLIED_END_TAGS = {
    "li": ((("li",), ("ul", "ol", "menu")),),
    "dt": ((("dt", "dd"), ("dl",)),),
    "dd": ((("dt", "dd"), ("dl",)),),
    "td": ((("td", "th"), ("tr", *_TABLE)),),
    "th": ((("td", "th"), ("tr", *_TABLE)),),
    "tr": ((("td", "th"), _TABLE), (("tr",), _TABLE)),
    "tbody": ((("td", "th"), _TABLE), (("tr",), _TABLE), (("thead", "tbody", "tfoot"), _TABLE)),
    "tfoot": ((("td", "th"), _TABLE), (("tr",), _TABLE), (("thead", "tbody", "tfoot"), _TABLE)),
    "option": ((("option",), ("select", "datalist")),),
    **{tag: _BLOCK_ENDS_P for tag in (
        "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form",
        "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section",
        "table", "ul",
    )},
}

# --- fixed values: how the platforms' listings are written --------------------------
PLATFORM_YEAR = r"\b((?:19|20)\d{2})\b"
PLATFORM_PRICE = r"\$\s?([\d,]{3,})"
PLATFORM_MILES = r"(?i)([\d,]{3,})\s*(?:mi\b|miles)"
PLATFORM_PAGE_END = r"(?is)(?:<footer\b|</main>|</body>|</html>).*$"
PLATFORM_DATA_VIN = r"<[a-zA-Z][a-zA-Z0-9]*\s[^>]*data-vin="
CARSFORSALE_LINK = r"(?i)/details/(?:[a-z]+-)?(\d{4})-([a-z0-9]+)-([a-z0-9-]+?)/(\d+)"
DWS_CARD = "dws-vehicle-listing-item-title"
DWS_LABEL = r"^[A-Za-z /]+?\s"
DWS_PRICE = r"(\$[\d,]{3,})"
DEALERSYNC_MILES = r"(?i)([\d,]{2,})\s+\d{1,2}\s*MPG"
DEALERSYNC_LINK = "detail|/inventory/"
DEALR_CARD = r"(?<![\w-])dealr-inventory-vehicle(?![\w-])"
DEALR_LINK = "inventory/|/vehicle"
DEALR_SLUG = r"^(19|20)\d{2}-"
DEALR_STOCK = r"(?i)Stock\s+([A-Za-z0-9-]+)"
DEALR_MILES = r"(?i)Mileage\s+([\d,]+)"
DEALR_EXTERIOR_STOP = r"Interior|Engine|Mileage|Stock|MPG|\$"
DEALR_INTERIOR_STOP = r"Engine|Exterior|Mileage|Stock|MPG|\$"
DEALR_ENGINE_STOP = r"MPG|Mileage|Stock|Exterior|Interior|\$"
OVERFUEL_PRICE = r"(?i)(?:No-haggle price|Sale Price|Our Price|Internet Price|Price)\s*\$\s?([\d,]{3,})"
OVERFUEL_STOCK = r"(?i)Stock\s*#?\s*([A-Za-z0-9-]+)"
OVERFUEL_MAKE = r"(?i)make_([a-z0-9]+)"
OVERFUEL_MILES = r"(?i)([\d,]+)\s*miles"
CARSFORSALE_TRANSMISSION = r"(?i)Transmission\s+([A-Za-z0-9 -]+?)(?=\s+(?:Drivetrain|Engine|Exterior|Fuel|VIN|$))"
DETAIL_VIN = r"(?i)VIN[:\s]{1,4}([A-HJ-NPR-Z0-9]{17})"
DETAIL_STOCK = r"(?i)Stock\s*#?[:\s]{1,4}([A-Za-z0-9-]{2,})"
LABELLED_DRIVETRAIN = r"(?i)Drivetrain\s+([A-Za-z0-9]+)"
SLUG_YEAR = r"^(19|20)\d{2}$"

# --- fixed values: cascade layers and coverage -------------------------------------
STRATEGY_PRIORITY = {
    "platform": 0, "api": 1, "embedded": 2, "navigate": 3, "unlocked": 4, "ai": 5,
}
LEDGER_ATTEMPTS = 15
COVERAGE_FIELDS = [
    "vin", "year", "make", "model", "trim", "mileage", "price", "stock_number",
    "location", "url", "image_url",
]
EXPORT_FIELDS = ["vin", "year", "make", "model", "mileage", "stock_number", "price"]
SOURCE_LD, SOURCE_STATE, SOURCE_INLINE = (
    "JSON-LD", "estado inicial del framework", "JSON inline",
)
