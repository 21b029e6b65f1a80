"""Words at the end of a title that never name a color. Further words are read from a file."""

# fixed values: goods, finishes, places, sizes and occasions that end titles
NOUNS = (
    "wallet", "necklace", "earrings", "earring", "bracelet", "ring", "watch", "sneakers", "flats", "mules",
    "scarf", "shawl", "hat", "case", "chain", "pochette", "pouch", "holder", "strap", "shopping", "purse",
    "city", "sunglasses", "charm", "diamonds", "diamond", "camera", "saddle", "baguette", "shopper", "cover",
    "book", "belt", "brooch", "luggage", "boston", "bandeau", "sandals", "trunk", "waist", "loop", "boots",
    "cotton", "jumbo", "pendant", "zip", "box", "cabas", "briefcase", "bucket", "pocket", "organizer",
    "loafers", "knot", "set", "flat", "duffle", "padlock", "bowler", "teen", "maxi", "choker", "palais",
    "souple", "clip", "envelope", "minaudiere", "college", "mesh", "pumps", "tweed", "compact", "lipstick",
    "tassel", "malle", "companion", "bowling", "spike", "petite", "pearls", "shadow", "chevron", "rockstud",
    "puffer", "espadrilles", "perforated", "diaper", "jacket", "swing", "snapshot", "slides", "street",
    "interlocking", "giant", "medallion", "basket", "buckle", "toy", "perfect", "travel", "flap", "handle",
    "woc", "caviar", "soft", "lambskin", "metal", "sterling", "drawstring", "logo", "wool", "nylon", "denim",
    "crystal", "python", "fabric", "textile", "cloth", "resin", "ceramic", "hardware", "stud", "studs",
    "pearl", "beads", "lock", "zipper", "clasp", "keychain", "card", "shoulder", "satin", "velvet", "knit",
    "rubber", "grain", "grained", "smooth", "matte", "glossy", "embroidered", "striped", "stripes", "check",
    "plaid", "patch", "vertical", "horizontal", "round", "square", "oval", "deep", "high", "low", "open",
    "closed", "double", "single", "top", "front", "back", "side", "used", "good", "work", "evening",
    "summer", "winter", "sport", "beach", "school", "office", "laptop", "phone", "key", "coin",
)

# fixed values: modifiers and textures that end titles but are no color words of their own
MODIFIERS = (
    "embossed", "printed", "aged", "washed", "reverse", "fluo", "neon", "electric", "electrique", "optic",
    "optical", "iridescent", "transparent", "translucent", "gradient", "degrade", "monochrome", "multicolor",
    "colorblock", "reversible", "convertible", "adjustable", "perfect", "classic", "iconic", "regular",
    "original", "vintage", "archive", "limited", "edition", "special", "collaboration", "animation",
    "christmas", "xmas", "holiday", "seasonal", "travel", "shopping", "accessoires", "accessories",
    "accessoire", "west", "east", "north", "south", "left", "right", "off", "on", "all", "the", "you", "day",
    "night", "time", "first", "last", "new", "old", "big", "baby", "toy", "heart", "flower", "flowers", "love",
    "joy", "star", "moon", "sun", "air", "water", "fire", "ice", "snow", "rain", "wind", "cloud", "cloudy",
    "storm", "fog", "hot", "warm", "cool", "cold", "fresh", "sweet", "sour", "bitter", "salty", "spicy", "bum",
    "web", "jour", "rock",
)
