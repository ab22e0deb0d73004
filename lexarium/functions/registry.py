"""Registries: clause patterns, cues, negatives, components, document forms, countries and labels.

Every operator takes its registry as a parameter; these are the defaults.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession

# The tables below must read as they do for results to agree with published ones.

#: name, family, version, scope, pattern
PATTERNS = [
    ("collective_action", "collective_action", "1.1.0", "both", r"(?:collective\s+action|modification\s+(?:of|to)\s+(?:the\s+)?(?:terms|debt\s+securities|bonds?|notes?)|amendment\s+(?:of|to)\s+(?:the\s+)?(?:terms|conditions)|consent\s+of\s+(?:the\s+)?holders?\s+of\s+not\s+less\s+than|aggregation\s+provisions?|single[- ]limb\s+voting|two[- ]limb\s+voting|double[- ]limb\s+voting|reserved\s+matter|meeting(?:s)?\s+of\s+(?:the\s+)?(?:note|bond)holders)"),
    ("pari_passu", "pari_passu", "1.1.0", "both", r"(?:pari\s+passu|rank(?:s|ing)?\s+(?:at\s+least\s+)?equal(?:ly)?\s+(?:in\s+right\s+of\s+payment|and\s+ratably)|equal\s+ranking\s+(?:with|to)|rank\s+without\s+(?:any\s+)?preference\s+among\s+themselves|(?:at\s+least\s+)?equal\s+priority\s+status|unsecured\s+and\s+unsubordinated\s+(?:public\s+)?(?:external\s+)?(?:indebtedness|obligations))"),
    ("feature__governing_law", "governing_law", "1.1.0", "both", r"(?:governed\s+by\s+(?:and\s+(?:construed|interpreted)\s+in\s+accordance\s+with\s+)?(?:the\s+)?(?:laws?\s+of\b|English\s+law)|subject\s+to\s+(?:the\s+)?(?:laws?\s+of\b|Netherlands\s+law)|choice\s+of\s+\w+\s+law\s+as\s+(?:the\s+)?governing\s+law|governing\s+law(?:\s+and\s+(?:jurisdiction|enforcement|arbitration))?|applicable\s+law\s+and\s+jurisdiction)"),
]

#: clause family, cue group, pattern; the group "heading" is looked for in headings, the others in bodies
CUES = [
    ("collective_action", "heading", r"collective\s+action"),
    ("collective_action", "heading", r"modification\s+of\s+(the\s+)?(conditions|terms)"),
    ("collective_action", "heading", r"amendment\s+and\s+waiver"),
    ("collective_action", "heading", r"meetings?\s+of\s+(note|bond)holders"),
    ("collective_action", "heading", r"voting\s+and\s+amendments"),
    ("collective_action", "voting_threshold", r"consent\s+of\s+(the\s+)?holders\s+of\s+not\s+less\s+than"),
    ("collective_action", "voting_threshold", r"holders?\s+of\s+\d+%"),
    ("collective_action", "voting_threshold", r"\d+%\s+of\s+the\s+aggregate\s+principal"),
    ("collective_action", "voting_threshold", r"extraordinary\s+resolution"),
    ("collective_action", "voting_threshold", r"written\s+resolution"),
    ("collective_action", "voting_threshold", r"two[\s-]+thirds"),
    ("collective_action", "voting_threshold", r"66\s*(?:⅔|2/3)"),
    ("collective_action", "aggregation", r"aggregat(ion|ed)\s+(provisions?|voting)"),
    ("collective_action", "aggregation", r"single[\s-]+(series|limb)\s+(voting|modification)"),
    ("collective_action", "aggregation", r"cross[\s-]+series"),
    ("collective_action", "aggregation", r"uniformly\s+applicable"),
    ("collective_action", "reserved_matter", r"reserved\s+matter"),
    ("collective_action", "reserved_matter", r"reserve[d]?\s+matter\s+modification"),
    ("collective_action", "meeting_quorum", "quorum"),
    ("collective_action", "meeting_quorum", r"meeting\s+of\s+(note|bond)?holders"),
    ("pari_passu", "heading", r"status\s+of\s+the\s+(notes|bonds|securities)"),
    ("pari_passu", "heading", "ranking"),
    ("pari_passu", "heading", r"pari\s+passu"),
    ("pari_passu", "ranking", r"pari\s+passu"),
    ("pari_passu", "ranking", r"rank\s+(equally|pari\s+passu)"),
    ("pari_passu", "ranking", r"equal\s+(ranking|priority)"),
    ("pari_passu", "ranking", r"without\s+preference"),
    ("pari_passu", "obligation", r"unsecured\s+and\s+unsubordinated"),
    ("pari_passu", "obligation", r"direct,?\s+(unconditional,?\s+)?unsecured"),
    ("governing_law", "heading", r"governing\s+law"),
    ("governing_law", "heading", r"applicable\s+law"),
    ("governing_law", "heading", r"choice\s+of\s+law"),
    ("governing_law", "heading", r"law\s+and\s+jurisdiction"),
    ("governing_law", "heading", r"governing\s+law\s+and\s+enforcement"),
    ("governing_law", "jurisdiction", r"governed\s+by\s+(the\s+)?law(s)?\s+of"),
    ("governing_law", "jurisdiction", r"construed\s+in\s+accordance\s+with"),
    ("governing_law", "jurisdiction", r"subject\s+to\s+(the\s+)?(law(s)?|jurisdiction)\s+of"),
    ("governing_law", "law_reference", r"(english|new\s+york|german|japanese)\s+law"),
    ("governing_law", "law_reference", r"laws?\s+of\s+(the\s+)?(state\s+of\s+)?(new\s+york|england|germany|japan)"),
    ("governing_law", "law_reference", r"(interpreted|construed)\s+in\s+accordance\s+with\s+(the\s+)?law"),
    ("sovereign_immunity", "heading", r"sovereign\s+immunit(y|ies)"),
    ("sovereign_immunity", "heading", r"waiver\s+of\s+immunit(y|ies)"),
    ("sovereign_immunity", "heading", r"immunit(y|ies)\s+from\s+(jurisdiction|execution|suit)"),
    ("sovereign_immunity", "heading", r"consent\s+to\s+(jurisdiction|service|suit)"),
    ("sovereign_immunity", "heading", r"no\s+immunit(y|ies)"),
    ("sovereign_immunity", "waiver", r"irrevocabl(e|y)\s+(waive|consent)"),
    ("sovereign_immunity", "waiver", r"waive(s|d)?\s+(any|all|its)?\s*immunit(y|ies)"),
    ("sovereign_immunity", "waiver", r"sovereign\s+or\s+crown\s+immunit(y|ies)"),
    ("sovereign_immunity", "waiver", r"foreign\s+sovereign\s+immunit(y|ies)\s+act"),
    ("sovereign_immunity", "waiver", r"state\s+immunit(y|ies)\s+act"),
    ("sovereign_immunity", "execution", r"attachment\s+(prior|before)\s+to?\s+judgment"),
    ("sovereign_immunity", "execution", r"execution\s+of\s+judgment"),
    ("sovereign_immunity", "execution", r"immunit(y|ies)\s+from\s+(attachment|execution|seizure)"),
    ("negative_pledge", "heading", r"negative\s+pledge"),
    ("negative_pledge", "heading", r"limitation\s+on\s+liens"),
    ("negative_pledge", "heading", r"restriction\s+on\s+(security|liens|encumbrances)"),
    ("negative_pledge", "heading", r"negative\s+pledge\s+covenant"),
    ("negative_pledge", "heading", r"restrictive\s+covenants"),
    ("negative_pledge", "pledge", r"will\s+not[^.]{0,60}create\s+(or\s+(permit|allow)(\s+to\s+(exist|subsist))?\s+)?(any\s+)?(lien|security\s+interest|encumbrance|mortgage)"),
    ("negative_pledge", "pledge", r"create\s+or\s+(permit|allow)\s+(to\s+(?:exist|subsist)\s+)?[^.]{0,40}?(lien|security\s+interest|encumbrance|mortgage)"),
    ("negative_pledge", "pledge", r"not\s+(to\s+)?(grant|create)\s+(or\s+(allow|permit)\s+)?(any\s+)?(lien|security\s+interest|encumbrance|mortgage)"),
    ("negative_pledge", "pledge", r"no\s+(lien|security\s+interest|mortgage|charge)\s+(shall|will)\s+be\s+created"),
    ("negative_pledge", "exception", r"permitted\s+(lien|security|encumbrance|exception)"),
    ("negative_pledge", "exception", r"(except|unless|provided\s+that).{0,80}secured\s+(?:equally|ratabl|pari\s+passu)"),
    ("negative_pledge", "exception", r"secured\s+(equally|ratabl|rateabl|pari\s+passu)"),
    ("negative_pledge", "exception", r"equally\s+and\s+(ratabl|rateabl)"),
    ("events_of_default", "heading", r"events?\s+of\s+default"),
    ("events_of_default", "heading", r"default\s+and\s+enforcement"),
    ("events_of_default", "heading", "default.{0,40}acceleration"),
    ("events_of_default", "trigger", r"(non[\s-]?payment|failure\s+to\s+pay)"),
    ("events_of_default", "trigger", r"cross[\s-]?default"),
    ("events_of_default", "trigger", r"breach\s+of\s+(covenant|obligation|undertaking|representation)"),
    ("events_of_default", "trigger", r"(insolvency|bankruptcy|winding[\s-]?up|liquidation)"),
    ("events_of_default", "trigger", "moratorium"),
    ("events_of_default", "trigger", "repudiation"),
    ("events_of_default", "trigger", "(illegality|unlawfulness|invalidity)"),
    ("events_of_default", "consequence", r"(may\s+be\s+)?declared\s+(immediately\s+)?due\s+and\s+payable"),
    ("events_of_default", "consequence", "accelerat(e|ion|ed)"),
    ("events_of_default", "consequence", r"shall\s+become\s+(immediately\s+)?due"),
    ("acceleration", "heading", r"acceleration\s+of\s+(maturity|the\s+notes|the\s+bonds|the\s+securities)"),
    ("acceleration", "heading", r"enforcement\s+of\s+(the\s+)?(notes|bonds|securities)"),
    ("acceleration", "heading", r"default\s*;\s*acceleration"),
    ("acceleration", "mechanism", r"declared\s+(immediately\s+)?due\s+and\s+payable"),
    ("acceleration", "mechanism", r"principal\s+amount.{0,30}(become|declared)\s+(immediately\s+)?due"),
    ("acceleration", "trigger_reference", "accelerat(e|ion|ed)"),
    ("acceleration", "trigger_reference", r"shall\s+become\s+(immediately\s+)?due"),
    ("acceleration", "trigger_reference", r"upon\s+(the\s+)?occurrence\s+of"),
    ("dispute_resolution", "heading", r"dispute\s+resolution"),
    ("dispute_resolution", "heading", "arbitration"),
    ("dispute_resolution", "heading", r"submission\s+to\s+jurisdiction"),
    ("dispute_resolution", "heading", r"forum\s+selection"),
    ("dispute_resolution", "heading", r"law\s+and\s+jurisdiction"),
    ("dispute_resolution", "forum", r"(ICSID|ICC|LCIA|UNCITRAL|AAA)\s+(arbitration|rules)"),
    ("dispute_resolution", "forum", r"submit(s|ted)?\s+to\s+the\s+(exclusive\s+)?jurisdiction"),
    ("dispute_resolution", "forum", r"(courts?\s+of|tribunal)\s+(England|New\s+York|the\s+State)"),
    ("dispute_resolution", "mechanism", "arbitrat(e|ion|ed|or)"),
    ("dispute_resolution", "mechanism", r"exclusive\s+jurisdiction"),
    ("dispute_resolution", "mechanism", r"(irrevocably\s+)?submit"),
    ("additional_amounts", "heading", r"additional\s+amounts"),
    ("additional_amounts", "heading", r"gross[\s-]?up"),
    ("additional_amounts", "heading", r"tax(ation)?\s+(gross[\s-]?up|indemnit)"),
    ("additional_amounts", "heading", r"taxation\s+and\s+additional\s+amounts"),
    ("additional_amounts", "obligation", r"additional\s+amounts\s+(as\s+)?will\s+result\s+in"),
    ("additional_amounts", "obligation", r"(pay|paying)\s+(such\s+)?additional\s+amounts"),
    ("additional_amounts", "obligation", r"gross[\s-]?up"),
    ("additional_amounts", "tax_context", r"without\s+(withholding|deduction)\s+for\s+(or\s+on\s+account\s+of\s+)?(any\s+)?tax"),
    ("additional_amounts", "tax_context", r"(withholding|deduction)\s+(is\s+)?required\s+by\s+law"),
    ("additional_amounts", "tax_context", r"tax(es)?\s+(imposed|levied|assessed)\s+by"),
    ("redemption", "heading", r"(optional|early|mandatory|scheduled|partial)\s+redemption"),
    ("redemption", "heading", r"redemption\s+(and\s+)?purchase"),
    ("redemption", "heading", r"(repurchase|repayment)\s+(at\s+the\s+option|upon\s+request)"),
    ("redemption", "heading", r"no\s+(other\s+)?redemption"),
    ("redemption", "mechanism", r"redeem(ed)?\s+(all\s+or\s+(a\s+)?part|in\s+whole\s+or\s+in\s+part)"),
    ("redemption", "mechanism", r"at\s+a\s+redemption\s+price"),
    ("redemption", "mechanism", r"tax\s+redemption"),
    ("redemption", "terms", r"(call|make[\s-]?whole)\s+(premium|amount|price)"),
    ("redemption", "terms", r"redemption\s+date"),
    ("redemption", "terms", r"notice\s+of\s+redemption"),
    ("indebtedness_definition", "heading", r"(definition|interpretation)\s+of\s+indebtedness"),
    ("indebtedness_definition", "heading", r"(external|public)\s+(indebtedness|debt)\s+(definition|means)"),
    ("indebtedness_definition", "heading", r"(relevant|financial)\s+indebtedness"),
    ("indebtedness_definition", "heading", r"certain\s+definitions"),
    ("indebtedness_definition", "definition", r"indebtedness\s+means"),
    ("indebtedness_definition", "definition", r"(external|public)\s+(indebtedness|debt)\s+(means|shall\s+mean)"),
    ("indebtedness_definition", "scope", r"(obligation|liability)\s+for\s+(borrowed\s+money|the\s+payment)"),
    ("indebtedness_definition", "scope", r"(guarantee|guaranty|indemnity)\s+of\s+(any\s+)?indebtedness"),
    ("indebtedness_definition", "scope", r"(bonds?|notes?|debentures?|loan\s+stock)"),
    ("amendment_waiver", "heading", r"amendment\s+and\s+waiver"),
    ("amendment_waiver", "heading", r"modification\s+and\s+waiver"),
    ("amendment_waiver", "heading", r"amendments?\s+to\s+(the\s+)?(conditions|terms)"),
    ("amendment_waiver", "heading", r"waiver\s+and\s+amendment"),
    ("amendment_waiver", "mechanism", r"(amend|modify|supplement|waive)\s+(any|all|the)\s+(provisions?|conditions?|terms?)"),
    ("amendment_waiver", "mechanism", r"(written\s+)?consent\s+of\s+(the\s+)?holders?\s+of"),
    ("amendment_waiver", "mechanism", r"without\s+the\s+consent\s+of\s+(any\s+)?holder"),
    ("amendment_waiver", "threshold", r"\d+%\s+of\s+the\s+(aggregate|outstanding)\s+principal"),
    ("amendment_waiver", "threshold", r"extraordinary\s+resolution"),
    ("amendment_waiver", "threshold", r"(unanimous|majority)\s+consent"),
    ("conditions_precedent", "heading", r"conditions?\s+precedent"),
    ("conditions_precedent", "heading", r"conditions?\s+to\s+(effectiveness|disbursement|drawdown|closing)"),
    ("conditions_precedent", "heading", r"conditions?\s+for\s+(effectiveness|disbursement|drawdown)"),
    ("conditions_precedent", "condition", r"(shall|will)\s+not\s+(be\s+)?obligat?ed\s+to\s+(make|disburse|fund)"),
    ("conditions_precedent", "condition", r"condition\s+precedent\s+to\s+(each|the|any)"),
    ("conditions_precedent", "condition", r"(effectiveness|availability)\s+of\s+(the\s+)?(loan|facility|credit)"),
    ("conditions_precedent", "requirement", r"(legal\s+opinion|certificate|evidence)\s+(satisfactory|acceptable)\s+to"),
    ("conditions_precedent", "requirement", r"no\s+(event\s+of\s+)?default\s+(shall\s+have\s+)?occurred"),
    ("conditions_precedent", "requirement", r"representations?\s+and\s+warranties?\s+(are|shall\s+be)\s+true"),
    ("payment_mechanics", "heading", r"payments?\s+(of\s+)?(principal|interest)"),
    ("payment_mechanics", "heading", r"method\s+of\s+payment"),
    ("payment_mechanics", "heading", r"payments?\s+(and\s+)?calculations?"),
    ("payment_mechanics", "heading", r"payments?\s+on\s+the\s+(notes|bonds|securities)"),
    ("payment_mechanics", "mechanism", r"(principal|interest)\s+(shall|will)\s+be\s+(payable|paid)\s+(on|at|in)"),
    ("payment_mechanics", "mechanism", r"payments?\s+(shall|will)\s+be\s+made\s+(in|by|through)"),
    ("payment_mechanics", "mechanism", r"(paying|fiscal)\s+agent"),
    ("payment_mechanics", "timing", r"(interest|coupon)\s+payment\s+date"),
    ("payment_mechanics", "timing", r"(maturity|redemption)\s+date"),
    ("payment_mechanics", "timing", r"(business|banking)\s+day\s+convention"),
    ("trustee_duties", "heading", r"(duties|responsibilities|role)\s+of\s+(the\s+)?trustee"),
    ("trustee_duties", "heading", r"trustee\s+(duties|responsibilities|obligations)"),
    ("trustee_duties", "heading", r"the\s+trustee"),
    ("trustee_duties", "duty", r"trustee\s+(shall|will|may)\s+(not\s+)?(be\s+)?(liable|responsible|obligat?ed)"),
    ("trustee_duties", "duty", r"(indemnif|compensat)(y|ied|ion)\s+(the\s+)?trustee"),
    ("trustee_duties", "duty", r"trustee\s+(shall|will)\s+(act|exercise|perform)"),
    ("trustee_duties", "limitation", r"trustee\s+(shall\s+)?not\s+be\s+(required|bound|obligat?ed)\s+to"),
    ("trustee_duties", "limitation", r"(no|without)\s+(liability|responsibility)\s+on\s+the\s+part\s+of\s+(the\s+)?trustee"),
    ("trustee_duties", "limitation", r"(reasonable|due)\s+(care|diligence)"),
    ("disbursement", "heading", "disbursement"),
    ("disbursement", "heading", "drawdown"),
    ("disbursement", "heading", r"(loan|credit)\s+disbursement"),
    ("disbursement", "heading", r"availability\s+of\s+(the\s+)?(loan|facility|credit)"),
    ("disbursement", "mechanism", r"(disburse|draw\s*down|withdraw)\s+(the\s+)?(loan|proceeds|funds)"),
    ("disbursement", "mechanism", r"(disbursement|drawdown|withdrawal)\s+(request|application|notice)"),
    ("disbursement", "mechanism", r"(special|designated)\s+account"),
    ("disbursement", "condition", r"(disbursement|drawdown)\s+(shall|will)\s+be\s+(made|available)"),
    ("disbursement", "condition", r"(proceeds|funds)\s+(shall|will)\s+be\s+(deposited|credited|transferred)"),
    ("disbursement", "condition", "(tranche|instalment|installment)"),
    ("commitment", "heading", r"commitment\s+of\s+the\s+(bank|lender|issuer)"),
    ("commitment", "heading", r"the\s+commitment"),
    ("commitment", "heading", r"commitment\s+to\s+(lend|provide|make\s+available)"),
    ("commitment", "obligation", r"(agrees|commits|undertakes)\s+to\s+(lend|make\s+available|provide)"),
    ("commitment", "obligation", r"commitment\s+(amount|sum|total)"),
    ("commitment", "obligation", r"(aggregate|total)\s+commitment"),
    ("commitment", "terms", r"commitment\s+(fee|period|termination)"),
    ("commitment", "terms", r"(reduce|cancel|terminate)\s+(the\s+)?commitment"),
    ("commitment", "terms", r"(unutilized|undrawn|available)\s+(commitment|amount|portion)"),
]

#: category, pattern; ^ and $ hold at lines
NEGATIVES = [
    ("cross_reference", r"""(see|refer\s+to|described\s+(under|in))\s+["']"""),
    ("cross_reference", r"as\s+set\s+forth\s+in"),
    ("cross_reference", r"""under\s+["'].+["']"""),
    ("table_of_contents", r"\.{4,}"),
    ("table_of_contents", r"^\s*\d+\s*$"),
    ("summary_overview", r"(the\s+)?following\s+is\s+a\s+(brief\s+)?summary"),
    ("summary_overview", r"brief\s+description"),
    ("summary_overview", r"summary\s+of\s+(the\s+)?(principal\s+)?provisions"),
]

#: clause family, component, pattern
COMPONENTS = [
    ("collective_action", "voting_threshold", r"holders?\s+of\s+(not\s+less\s+than\s+)?\d+%"),
    ("collective_action", "voting_threshold", r"\d+%\s+of\s+the\s+aggregate"),
    ("collective_action", "voting_threshold", r"extraordinary\s+resolution"),
    ("collective_action", "reserved_matter", r"reserved\s+matter"),
    ("collective_action", "meeting_quorum", "quorum"),
    ("collective_action", "meeting_quorum", r"meeting\s+of\s+(note|bond)?holders"),
    ("collective_action", "meeting_quorum", r"written\s+resolution"),
    ("collective_action", "aggregation", "aggregat(ion|ed)"),
    ("collective_action", "aggregation", r"cross[\s-]+series"),
    ("collective_action", "aggregation", r"single[\s-]+limb"),
    ("pari_passu", "ranking", r"rank\s*(s|ing)?"),
    ("pari_passu", "ranking", r"pari\s+passu"),
    ("pari_passu", "ranking", "equally"),
    ("pari_passu", "ranking", r"without\s+preference"),
    ("pari_passu", "obligation", "unsecured"),
    ("pari_passu", "obligation", "unsubordinated"),
    ("pari_passu", "obligation", "direct"),
    ("governing_law", "jurisdiction", r"governed\s+by"),
    ("governing_law", "jurisdiction", r"laws?\s+of"),
    ("governing_law", "jurisdiction", r"(english|new\s+york|german)\s+law"),
    ("governing_law", "jurisdiction", r"construed\s+in\s+accordance"),
    ("sovereign_immunity", "waiver", r"waive(s|d)?\s+(any|all|its)?\s*immunit(y|ies)"),
    ("sovereign_immunity", "waiver", r"irrevocabl(e|y)\s+(waive|consent)"),
    ("sovereign_immunity", "execution", "(attachment|execution|seizure)"),
    ("negative_pledge", "pledge", r"(will\s+not|shall\s+not)\s+(create|grant|permit)"),
    ("negative_pledge", "pledge", r"no\s+(lien|security\s+interest|mortgage)"),
    ("negative_pledge", "exception", r"(except|unless|provided\s+that|permitted)"),
    ("events_of_default", "trigger", r"(non[\s-]?payment|failure\s+to\s+pay)"),
    ("events_of_default", "trigger", r"(cross[\s-]?default|insolvency|bankruptcy|moratorium)"),
    ("events_of_default", "trigger", r"breach\s+of\s+(covenant|obligation)"),
    ("events_of_default", "consequence", r"(declared|become)\s+(immediately\s+)?due\s+and\s+payable"),
    ("events_of_default", "consequence", "accelerat(e|ion|ed)"),
    ("acceleration", "mechanism", r"declared\s+(immediately\s+)?due\s+and\s+payable"),
    ("acceleration", "mechanism", "accelerat(e|ion|ed)"),
    ("dispute_resolution", "forum", "(ICSID|ICC|LCIA|UNCITRAL|courts?)"),
    ("dispute_resolution", "forum", "(jurisdiction|arbitration|tribunal)"),
    ("additional_amounts", "obligation", r"additional\s+amounts"),
    ("additional_amounts", "obligation", r"gross[\s-]?up"),
    ("additional_amounts", "obligation", r"without\s+(withholding|deduction)"),
    ("redemption", "mechanism", "redeem(ed)?"),
    ("redemption", "mechanism", r"redemption\s+price"),
    ("redemption", "mechanism", r"(call|make[\s-]?whole)"),
    ("indebtedness_definition", "definition", r"indebtedness\s+means"),
    ("indebtedness_definition", "definition", "(obligation|liability)"),
    ("indebtedness_definition", "definition", r"borrowed\s+money"),
]

#: Families captured as whole sections.
SECTION_FAMILIES = ["events_of_default", "conditions_precedent", "payment_mechanics", "trustee_duties", "disbursement"]

#: pattern, instrument family, role, form; the first that matches decides
FORMS = [
    (r"loan\s+agreement", "Loan", "Standalone", "Loan Agreement"),
    (r"financing\s+agreement", "Loan", "Standalone", "Loan Agreement"),
    (r"loan\s+contract", "Loan", "Standalone", "Loan Agreement"),
    (r"credit\s+agreement", "Loan", "Standalone", "Loan Agreement"),
    (r"application\s+for\s+admission\s+of\s+securities\s+to\s+the\s+official\s+list", "Bond", "Other", "Regulatory Filing"),
    (r"dissemination\s+of\s+a\s+regulatory\s+announcement", "Bond", "Other", "Regulatory Filing"),
    (r"contrato\s+de\s+pr[eé]stamo", "Loan", "Standalone", "Loan Agreement"),
    (r"\bfacility\s+agreement\b", "Loan", "Standalone", "Loan Agreement"),
    (r"\bform\s+18-k\b", "Bond", "Other", "Annual Report"),
    ("indenture", "Bond", "Standalone", "Indenture"),
    (r"trust\s+deed", "Bond", "Standalone", "Trust Deed"),
    (r"fiscal\s+agency\s+agreement", "Bond", "Standalone", "Fiscal Agency Agreement"),
    (r"amendment\s+(agreement|no\.?\s*\d)", "Other", "Amendment", "Other"),
    (r"supplement(al)?\s+(number|no\.?)\s*\d", "Bond", "Supplement", "Other"),
    (r"pricing\s+supplement", "Bond", "Supplement", "Pricing Supplement"),
    (r"final\s+terms", "Bond", "Supplement", "Final Terms"),
    (r"prospectus\s+supplement", "Bond", "Supplement", "Prospectus"),
    (r"preliminary\s+(offering\s+)?prospectus", "Bond", "Base document", "Prospectus"),
    (r"base\s+(offering\s+)?(prospectus|circular)", "Bond", "Base document", "Prospectus"),
    (r"offering\s+(circular|memorandum)", "Bond", "Base document", "Offering Circular"),
    (r"(?:^|\n)\s*prospectus\s*(?:\n|$)", "Bond", "Base document", "Prospectus"),
    (r"tender\s+offer", "Bond", "Other", "Regulatory Filing"),
]

#: form code | instrument family | role | form
FORM_CODES = [
    ("424B5", "Bond", "Supplement", "Prospectus"),
    ("424B4", "Bond", "Supplement", "Prospectus"),
    ("424B2", "Bond", "Supplement", "Pricing Supplement"),
    ("424B3", "Bond", "Base document", "Prospectus"),
    ("424B1", "Bond", "Base document", "Prospectus"),
    ("FWP", "Bond", "Supplement", "Pricing Supplement"),
    ("F-4", "Bond", "Base document", "Other"),
    ("18-K", "Bond", "Other", "Annual Report"),
    ("18-K/A", "Bond", "Other", "Annual Report"),
]

#: ISO-3 code and country
COUNTRIES = [
    ("AGO", "Angola"),
    ("ARG", "Argentina"),
    ("AUT", "Austria"),
    ("BHR", "Bahrain"),
    ("BIH", "Bosnia and Herzegovina"),
    ("BRA", "Brazil"),
    ("BRB", "Barbados"),
    ("CAN", "Canada"),
    ("CHN", "China"),
    ("CMR", "Cameroon"),
    ("COL", "Colombia"),
    ("CYP", "Cyprus"),
    ("ECU", "Ecuador"),
    ("EGY", "Egypt"),
    ("ETH", "Ethiopia"),
    ("GHA", "Ghana"),
    ("GIN", "Guinea"),
    ("GUY", "Guyana"),
    ("HUN", "Hungary"),
    ("IDN", "Indonesia"),
    ("ISL", "Iceland"),
    ("ISR", "Israel"),
    ("ITA", "Italy"),
    ("JAM", "Jamaica"),
    ("JOR", "Jordan"),
    ("JPN", "Japan"),
    ("KAZ", "Kazakhstan"),
    ("KEN", "Kenya"),
    ("KGZ", "Kyrgyzstan"),
    ("KWT", "Kuwait"),
    ("LVA", "Latvia"),
    ("LKA", "Sri Lanka"),
    ("MAR", "Morocco"),
    ("MDA", "Moldova"),
    ("MNE", "Montenegro"),
    ("NGA", "Nigeria"),
    ("NLD", "Netherlands"),
    ("PAN", "Panama"),
    ("PER", "Peru"),
    ("PHL", "Philippines"),
    ("RWA", "Rwanda"),
    ("SAU", "Saudi Arabia"),
    ("SEN", "Senegal"),
    ("SLE", "Sierra Leone"),
    ("SRB", "Serbia"),
    ("SWE", "Sweden"),
    ("TUR", "Turkey"),
    ("UGA", "Uganda"),
    ("UZB", "Uzbekistan"),
    ("VEN", "Venezuela"),
    ("ZAF", "South Africa"),
    ("ZMB", "Zambia"),
]

#: label and family; - for none
LABELS = [
    ("VotingCollectiveActionModification_AmendmentandWaiver", "collective_action"),
    ("VotingCollectiveActionModification_Double_Limb", "collective_action"),
    ("VotingCollectiveActionModification_Single_Limb", "collective_action"),
    ("VotingCollectiveActionModification_Supermajority", "collective_action"),
    ("VotingCollectiveActionModification_UnanimousConsent", "collective_action"),
    ("VotingRequirementforAcceleration_AmendmentandWaiver", "acceleration"),
    ("Acceleration_Consequences", "acceleration"),
    ("StatusofObligationPariPassu_RepresentationsWarranties", "pari_passu"),
    ("NegativePledge_BorrowerCovenantsUndertakings", "negative_pledge"),
    ("GoverningLaw_Enforcement", "governing_law"),
    ("Non-paymentFailuretoPay_EventsofDefaultandConsequences", "events_of_default"),
    ("CovenantDefault_EventsofDefaultandConsequences", "events_of_default"),
    ("CrossDefault_EventsofDefaultandConsequences", "events_of_default"),
    ("Other_EventsofDefaultandConsequences", "events_of_default"),
    ("UnlawfulnessIllegalityInvalidityBorrower_EventsofDefaultandConsequences", "events_of_default"),
    ("MoratoriumRepudiationAuthority_EventsofDefaultandConsequences", "events_of_default"),
    ("InsolvencyBankruptcy_EventsofDefaultandConsequences", "events_of_default"),
    ("Non-complianceJudgement_EventsofDefaultandConsequences", "events_of_default"),
    ("MaterialAdverseChange_EventsofDefaultandConsequences", "events_of_default"),
    ("MisrepresentationRepresentation_EventsofDefaultandConsequences", "events_of_default"),
    ("AmendmentandWaiver_AmendmentandWaiver", "amendment_waiver"),
    ("Meetingsinc.WrittenConsent_AmendmentandWaiver", "amendment_waiver"),
    ("Interest_FinancialTerms", "interest"),
    ("Commitment_FinancialTerms", "commitment"),
    ("Fees_FinancialTerms", "fees"),
    ("Purpose_FinancialTerms", "purpose"),
    ("CurrencyofDenominationandorPayment_FinancialTerms", "currency"),
    ("PaymentMechanics_Repayment", "payment_mechanics"),
    ("RedemptionRepurchaseEarlyRepayment_Repayment", "redemption"),
    ("AdditionalAmounts_Repayment", "additional_amounts"),
    ("DisputeResolution_Enforcement", "dispute_resolution"),
    ("SovereignImmunityWaiver_Enforcement", "sovereign_immunity"),
    ("ConditionsUtilization_ConditionsPrecedent", "conditions_precedent"),
    ("ConditionsEffectiveness_ConditionsPrecedent", "conditions_precedent"),
    ("Information_BorrowerCovenantsUndertakings", "information_covenants"),
    ("UseofProceeds_BorrowerCovenantsUndertakings", "use_of_proceeds"),
    ("BooksandRecords_BorrowerCovenantsUndertakings", "books_records"),
    ("Other_BorrowerCovenantsUndertakings", None),
    ("DutiesofTrusteeFiscalAgent_CoordinationAdministration", "trustee_duties"),
    ("Indebtedness_Definitions", "indebtedness_definition"),
    ("UtilizationBorrowing_Disbursement", "disbursement"),
    ("InternalReference", None),
    ("externallink1", None),
    ("externallink2", None),
    ("externallink3", None),
]


#: name, pattern of the page scan; any case
PAGE_PATTERNS = [
    ("CAC", "(?:collective action|CAC|modification.*resolution|aggregat(?:ed|ion).*clause|modification.*majority|modification.*voting|Reserved Matter)"),
    ("PARI_PASSU", "(?:pari passu|rank equally|equal(?:ly)? (?:and ratably|rank)|same rank|pro[- ]?rata)"),
    ("EVENTS_OF_DEFAULT", "(?:Events? of Default|failure to pay|moratorium)"),
    ("GOVERNING_LAW", "(?:governing law|governed by|subject to (?:the laws of |English law|New York law))"),
    ("NEGATIVE_PLEDGE", "(?:negative pledge|not.*create.*(?:lien|security interest)|Lien|Security Interest)"),
    ("SOVEREIGN_IMMUNITY", "(?:sovereign immunity|waive.*immunity|irrevocably waive|Waiver of Immunity)"),
    ("CROSS_DEFAULT", "(?:cross[- ]?default|cross[- ]?acceleration)"),
    ("EXTERNAL_INDEBTEDNESS", "(?:External Indebtedness|Public External Indebtedness)"),
    ("ACCELERATION", "(?:acceleration|accelerate|immediately due and payable)"),
    ("TRUSTEE_FISCAL_AGENT", "(?:Fiscal Agent|Trustee|Agent Bank)"),
]

# The headers under which clauses of these types stand.
#: clause type, header
CLAUSE_HEADERS = [
    ("CAC", "(?i)(?:Collective Action|Modification|Reserved Matter)"),
    ("PARI_PASSU", r"(?i)(?:\d+\.?\s*Status of the Notes|Status of the Notes|Ranking|Pari Passu|rank.*pari passu)"),
    ("EVENTS_OF_DEFAULT", r"(?i)(?:\d+\.\s*Events? of Default)"),
    ("GOVERNING_LAW", r"(?i)(?:\d+\.?\s*Governing Law|Governing Law and Submission)"),
    ("NEGATIVE_PLEDGE", r"(?i)(?:\d+\.\s*Negative Pledge)"),
    ("SOVEREIGN_IMMUNITY", "(?i)(?:Waiver of (?:Sovereign )?Immunity|Consent to Enforcement)"),
    ("CROSS_DEFAULT", "(?i)(?:Cross[- ]?[Dd]efault)"),
    ("EXTERNAL_INDEBTEDNESS", "(?i)(?:External Indebtedness)"),
    ("ACCELERATION", "(?i)(?:Acceleration)"),
    ("TRUSTEE_FISCAL_AGENT", "(?i)(?:Fiscal Agent|Trustee)"),
]

#: name, pattern of facts about a document
METADATA = [
    ("governing_law", "(?i)(English law|New York law|governed by the laws of [A-Z][a-z]+)"),
    ("isin", r"\b[A-Z]{2}[A-Z0-9]{9}[0-9]\b"),
    ("listing_exchange", "(?i)(London Stock Exchange|Euronext Dublin|Irish Stock Exchange|Ghana Stock Exchange|Luxembourg Stock Exchange|Singapore Exchange)"),
]


def grouped(table: list[tuple[str, str, str]]) -> dict[str, dict[str, list[str]]]:
    """family -> group -> patterns of a three-column table."""
    out: dict[str, dict[str, list[str]]] = defaultdict(lambda: defaultdict(list))
    for family, group, p in table:
        out[family][group].append(p)
    return {f: dict(g) for f, g in out.items()}


def patterns() -> list[dict[str, str]]:
    return [dict(zip(("name", "family", "version", "scope", "pattern"), r, strict=True)) for r in PATTERNS]


def page_patterns() -> list[dict[str, str]]:
    return [dict(zip(("name", "pattern"), r, strict=True)) for r in PAGE_PATTERNS]


def cues() -> dict[str, dict[str, list[str]]]:
    return grouped(CUES)


def cues_of(family: str) -> dict[str, list[str]] | None:
    return cues().get(family)


def families() -> list[str]:
    return sorted(cues())


def negatives() -> dict[str, list[str]]:
    out: dict[str, list[str]] = defaultdict(list)
    for category, p in NEGATIVES:
        out[category].append(p)
    return dict(out)


def clause_headers() -> dict[str, str]:
    """The header of each clause type; of a type of the page scan that has none, the pattern of the scan."""
    return {name: f"(?i){p}" for name, p in PAGE_PATTERNS} | dict(CLAUSE_HEADERS)


def components() -> dict[str, dict[str, list[str]]]:
    return grouped(COMPONENTS)


def forms() -> list[tuple[str, ...]]:
    return list(FORMS)


def form_codes() -> dict[str, tuple[str, ...]]:
    return {r[0]: r[1:] for r in FORM_CODES}


def labels() -> dict[str, str | None]:
    return dict(LABELS)


def table_of(spark: SparkSession, table: list[tuple[str, ...]], columns: str) -> DataFrame:
    """A registry as a DataFrame of strings with its row number ``ord``, for joins; registries are of a fixed, small size."""
    return spark.createDataFrame([(k, *r) for k, r in enumerate(table)], "ord int, " + ", ".join(f"{n} string" for n in columns.split()))
