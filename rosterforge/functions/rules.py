"""Rule data of the contact domain.  All literals here are fixed values."""

from __future__ import annotations

# Mail domains by (provider, brand, category).
_BIG4, _CABLE = "Big4_ISP", "Cable_Provider"
GENERAL = "General_Internet"
#: Suffixes under which the two portals issue addresses, by rule <name>.<suffix>.
YAHOO_SUFFIXES = (
    "com at be bg ca cl co.id co.il co.in co.kr co.nz co.th co.uk co.za com.ar com.au com.br com.co com.hk com.hr com.mx com.my com.pe com.ph com.sg "
    "com.tr com.tw com.ua com.ve com.vn cz de dk ee es fi fr gr hu ie in it lt lv nl no pl pt ro se sk"
)
AOL_SUFFIXES = "com at be ch cl co.nz co.uk com.ar com.au com.br com.co com.mx com.tr com.ve cz de dk es fi fr hk in it jp kr nl pl ru se tw"
#: Regions of the road-runner domains, by rule <region>.rr.com.
RR_REGIONS = "nc sc tx wi maine neo cinci columbus hawaii satx austin tampabay socal nycap rochester woh ec kc san triad insight"
_GROUPS = (
    ("Google", "Gmail", _BIG4, "gmail.com googlemail.com"),
    ("Microsoft", "Hotmail", _BIG4, "hotmail.com hotmail.co.uk hotmail.fr hotmail.de hotmail.it hotmail.es"),
    ("Microsoft", "Outlook", _BIG4, "outlook.com outlook.co.uk"),
    ("Microsoft", "Live", _BIG4, "live.com live.co.uk"),
    ("Microsoft", "MSN", _BIG4, "msn.com"),
    ("Yahoo", "Yahoo", _BIG4, " ".join(f"yahoo.{s}" for s in YAHOO_SUFFIXES.split())),
    ("Yahoo", "Yahoo", _BIG4, "ymail.com rocketmail.com y7mail.com myyahoo.com kimo.com ygm.com"),
    ("Yahoo", "AOL", _BIG4, " ".join(f"aol.{s}" for s in AOL_SUFFIXES.split())),
    ("Yahoo", "AOL", _BIG4, "aim.com aolchina.com aolnews.com aolvideo.com compuserve.com cs.com csi.com love.com wow.com games.com netscape.com netscape.net"),
    ("Yahoo", "Verizon", _BIG4, "verizon.net bellatlantic.net gte.net"),
    ("Yahoo", "Frontier", _BIG4, "frontier.com frontiernet.net myfrontiermail.com newnorth.net citlink.net epix.net"),
    ("Yahoo", "Cox", _BIG4, "cox.net"),
    ("Yahoo", "Rogers", _BIG4, "rogers.com"),
    ("Yahoo", "Sky", _BIG4, "sky.com"),
    ("Yahoo", "AT&T", _BIG4, "att.net att.com nvbell.net snet.net flash.net worldnet.att.net"),
    ("Yahoo", "SBCGlobal", _BIG4, "sbcglobal.net"),
    ("Yahoo", "BellSouth", _BIG4, "bellsouth.net"),
    ("Yahoo", "PacBell", _BIG4, "pacbell.net"),
    ("Yahoo", "SWBell", _BIG4, "swbell.net"),
    ("Yahoo", "Ameritech", _BIG4, "ameritech.net"),
    ("Yahoo", "Prodigy", _BIG4, "prodigy.net"),
    ("Yahoo", "BT", _BIG4, "btinternet.com"),
    (
        "Yahoo",
        "Yahoo",
        _BIG4,
        "aprilshowersflorists.com asylum.com bloomoffaribault.com dogsinthenews.com geocities.com goowy.com lemondrop.com mcom.com netbusiness.com "
        "robertgillingsproductions.com safesocial.com simivalleyflowers.com spinner.com switched.com urlesque.com vincentthepoet.com when.com wild4music.com wmconnect.com",
    ),
    ("Comcast", "Comcast", _CABLE, "comcast.net comcast.com xfinity.com"),
    ("Charter", "Spectrum", _CABLE, "charter.net charter.com spectrum.net brighthouse.com"),
    ("Spectrum", "Roadrunner", _CABLE, "rr.com twc.com roadrunner.com"),
    ("Spectrum", "Roadrunner", _CABLE, " ".join(f"{r}.rr.com" for r in RR_REGIONS.split())),
    ("CenturyLink", "CenturyLink", _CABLE, "centurylink.net centurylink.com"),
    ("CenturyLink", "Qwest", _CABLE, "q.com qwest.net qwest.com qwestoffice.net"),
    ("CenturyLink", "Embarq", _CABLE, "embarqmail.com"),
    ("CenturyLink", "CenturyTel", _CABLE, "centurytel.net"),
    ("CenturyLink", "US West", _CABLE, "uswest.net"),
    ("Altice", "Optimum", _CABLE, "optonline.net optimum.net cablevision.com"),
    ("Altice", "Suddenlink", _CABLE, "suddenlink.net suddenlinkmail.com"),
    ("EarthLink", "EarthLink", _CABLE, "earthlink.net earthlink.com"),
    ("EarthLink", "MindSpring", _CABLE, "mindspring.com"),
    ("Apple", "iCloud", _CABLE, "icloud.com me.com mac.com"),
    ("ViaSat", "WildBlue", _CABLE, "wildblue.net"),
    ("ViaSat", "Exede", _CABLE, "exede.net"),
    ("SpaceX", "Starlink", _CABLE, "starlink.com"),
    ("T-Mobile", "T-Mobile", _CABLE, "t-mobile.com"),
    ("T-Mobile", "Sprint", _CABLE, "sprint.com"),
    ("Cincinnati Bell", "Cincinnati Bell", _CABLE, "cincbell.net"),
    ("Cincinnati Bell", "Fuse", _CABLE, "fuse.net"),
)
#: Providers whose brand has the same name.
_PLAIN = (
    ("Mediacom", "mediacombb.net mchsi.com"),
    ("Windstream", "windstream.net windstream.com"),
    ("WOW", "wideopenwest.com wowway.com"),
    ("RCN", "rcn.com rcn.net"),
    ("Atlantic Broadband", "atlanticbb.net"),
    ("Sparklight", "cableone.net sparklight.net"),
    ("Midco", "midcomail.com midco.net"),
    ("Armstrong", "armstrong.com zoominternet.net"),
    ("Adelphia", "adelphia.net"),
    ("Juno", "juno.com"),
    ("NetZero", "netzero.net netzero.com"),
    ("PeoplePC", "peoplepc.com"),
    ("USA.net", "usa.net"),
    ("Excite", "excite.com"),
    ("HughesNet", "hughesnet.com"),
    ("Starband", "starband.net"),
    ("Sonic", "sonic.net"),
    ("Toast.net", "toast.net"),
    ("Grande", "grandecom.net"),
    ("GVTC", "gvtc.com"),
    ("Dallas.net", "dallas.net"),
    ("SWCP", "swcp.com"),
    ("Chibardun", "chibardun.net"),
    ("TDS", "tds.net tdstelecom.com"),
    ("Socket", "socket.net"),
    ("Everest", "everestkc.net"),
    ("Sunflower", "sunflower.com"),
    ("South Slope", "southslope.net"),
    ("FairPoint", "myfairpoint.net fairpoint.net"),
    ("MetroCast", "metrocast.net"),
    ("Atlantic BBN", "atlanticbbn.net"),
    ("Bresnan", "bresnan.net"),
    ("Bend Broadband", "bendbroadband.com"),
    ("Wave", "wavecable.com"),
    ("Clearwire", "clearwire.net"),
    ("Mail.com", "mail.com"),
    ("Email.com", "email.com"),
    ("USA.com", "usa.com"),
    ("Post.com", "post.com"),
    ("iName", "iname.com"),
    ("Lycos", "lycos.com"),
    ("Inbox.com", "inbox.com"),
    ("Consolidated", "consolidated.net"),
    ("Hawaiian Tel", "hawaiiantel.net"),
)
#: Any domain under this suffix that has no entry of its own.
RR_SUFFIX, RR_RULE = ".rr.com", ("Spectrum", "Roadrunner", _CABLE)


def domain_rules() -> list[tuple[str, str, str, str]]:
    """(domain, provider, brand, category) rows."""
    rows = [(d, p, b, c) for p, b, c, names in _GROUPS for d in names.split()]
    return rows + [(d, p, p, _CABLE) for p, names in _PLAIN for d in names.split()]


# Corrections of mistyped domains.
TYPOS = {
    "gmial.com": "gmail.com", "gmai.com": "gmail.com", "gamil.com": "gmail.com", "gmail.con": "gmail.com", "gmail.co": "gmail.com", "gmal.com": "gmail.com",
    "hotmal.com": "hotmail.com", "hotmai.com": "hotmail.com", "hotmail.con": "hotmail.com", "hotmial.com": "hotmail.com",
    "yaho.com": "yahoo.com", "yahooo.com": "yahoo.com", "yahoo.con": "yahoo.com", "yahho.com": "yahoo.com",
    "outllok.com": "outlook.com", "outlok.com": "outlook.com", "outlook.con": "outlook.com",
    "aoll.com": "aol.com", "aol.con": "aol.com", "comcast.ner": "comcast.net", "comast.net": "comcast.net",
}
# Top-level domains that the batch policy rejects.
COUNTRY_TLDS = (
    ".co.uk .uk .ca .au .de .fr .it .es .nl .be .at .ch .se .no .dk .fi .pl .cz .ru .ua .br .mx .ar .co .cl .pe .in .cn .jp .kr "
    ".tw .hk .sg .my .ph .th .vn .id .nz .za .ie .pt .gr .hu .ro .bg .sk .si .hr .rs .il .ae .sa .eg .tr .pk"
).split()
# Local parts of role accounts, and words that mark one anywhere in the local part.
ROLES = (
    "legal lawyer attorney counsel litigation spam abuse postmaster mailer-daemon mailerdaemon noreply no-reply no_reply donotreply do-not-reply "
    "bounce bounces return unsubscribe admin administrator root sysadmin webmaster hostmaster info information contact hello enquiry inquiry "
    "support help helpdesk service customerservice sales marketing advertising press media pr billing accounts accounting finance payments "
    "hr humanresources recruiting careers jobs security privacy compliance gdpr feedback suggestions complaints newsletter news updates alerts "
    "orders order shipping returns test testing demo example"
).split()
ROLE_WORDS = "spam abuse legal lawyer attorney".split()
# Words that make a local part suspicious.
SUSPICIOUS = "test fake temp xxx 123 asdf qwerty spam trash junk noreply donotreply".split()
# Domains that the import policy drops.
BLOCKED = "example.com test.com asdf.com amazon.com".split()
# Names of states.
STATES = {
    "ALABAMA": "AL", "ALASKA": "AK", "ARIZONA": "AZ", "ARKANSAS": "AR", "CALIFORNIA": "CA", "COLORADO": "CO", "CONNECTICUT": "CT", "DELAWARE": "DE",
    "FLORIDA": "FL", "GEORGIA": "GA", "HAWAII": "HI", "IDAHO": "ID", "ILLINOIS": "IL", "INDIANA": "IN", "IOWA": "IA", "KANSAS": "KS", "KENTUCKY": "KY",
    "LOUISIANA": "LA", "MAINE": "ME", "MARYLAND": "MD", "MASSACHUSETTS": "MA", "MICHIGAN": "MI", "MINNESOTA": "MN", "MISSISSIPPI": "MS", "MISSOURI": "MO",
    "MONTANA": "MT", "NEBRASKA": "NE", "NEVADA": "NV", "NEW HAMPSHIRE": "NH", "NEW JERSEY": "NJ", "NEW MEXICO": "NM", "NEW YORK": "NY",
    "NORTH CAROLINA": "NC", "NORTH DAKOTA": "ND", "OHIO": "OH", "OKLAHOMA": "OK", "OREGON": "OR", "PENNSYLVANIA": "PA", "RHODE ISLAND": "RI",
    "SOUTH CAROLINA": "SC", "SOUTH DAKOTA": "SD", "TENNESSEE": "TN", "TEXAS": "TX", "UTAH": "UT", "VERMONT": "VT", "VIRGINIA": "VA", "WASHINGTON": "WA",
    "WEST VIRGINIA": "WV", "WISCONSIN": "WI", "WYOMING": "WY", "DISTRICT OF COLUMBIA": "DC",
}
STATE_CODES = [*STATES.values(), "PR", "VI", "GU", "AS", "MP"]
# Ordered substring rules for mail-exchanger hosts.
MX_GROUPS = (
    ("google", "aspmx.l.google.com alt1.aspmx.l.google.com alt2.aspmx.l.google.com aspmx2.googlemail.com aspmx3.googlemail.com googlemail.com google.com"),
    ("microsoft", "mail.protection.outlook.com olc.protection.outlook.com outlook-com.olc.protection.outlook.com outlook.com hotmail.com microsoft.com"),
    ("yahoo", "yahoodns.net mail.yahoo.com mx-biz.mail.am0.yahoodns.net yahoo.com yahoomail.com"),
    ("hostgator", "hostgator.com websitewelcome.com hostmonster.com bluehost.com"),
    ("godaddy", "secureserver.net domaincontrol.com godaddy.com smtp.secureserver.net mailstore1.secureserver.net"),
    ("1and1", "1and1.com ionos.com schlund.de 1und1.de kundenserver.de mx00.ionos.com mx01.ionos.com"),
    ("zoho", "zoho.com zohomail.com zoho.eu mx.zoho.com mx2.zoho.com mx3.zoho.com"),
    ("siteground", "siteground.com mailspamprotection.com sgcpanel.com"),
    ("ovhcloud", "ovh.net ovh.com mx1.ovh.net mx2.ovh.net mx3.ovh.net"),
    ("protonmail", "protonmail.ch protonmail.com pm.me"),
    ("rackspace", "emailsrvr.com rackspace.com"),
    ("mimecast", "mimecast.com mimecast-offshore.com"),
    ("amazon", "amazonses.com amazonaws.com aws.com"),
    ("namecheap", "namecheap.com privateemail.com registrar-servers.com mx1.privateemail.com mx2.privateemail.com"),
    ("dreamhost", "dreamhost.com newdream.net"),
    ("networksolutions", "netsolmail.net networksolutions.com"),
    ("apple", "icloud.com apple.com me.com"),
    ("fastmail", "fastmail.com messagingengine.com"),
    ("barracuda", "barracudanetworks.com barracuda.com"),
    ("proofpoint", "pphosted.com proofpoint.com"),
    ("postmark", "postmarkapp.com"),
    ("sendgrid", "sendgrid.net sendgrid.com"),
    ("mailgun", "mailgun.org mailgun.com"),
    (
        "parked",
        "sedoparking.com sedo.com parkingcrew.net domainparking.com cashparking.com parkeddomain.com bodis.com above.com hugedomains.com afternic.com "
        "parklogic.com fabulous.com dan.com undeveloped.com skenzo.com parkingpage.net parked.com parkednicely.com domainsponsor.com oversee.net "
        "dsgeneration.com dsparking.com trafficz.com namedrive.com domainmonster.com domainnamesales.com buydomains.com",
    ),
)
GI_HOSTING = "hostgator godaddy 1and1 namecheap dreamhost networksolutions siteground ovhcloud zoho rackspace".split()
# Ordered labels of mail hosts.
HOSTING_LABELS = (
    ("bluehost.com", "Bluehost"), ("hostgator.com", "HostGator"), ("hostgator.com.br", "HostGator"), ("websitewelcome.com", "HostGator"), ("secureserver.net", "GoDaddy"),
    ("emailsrvr.com", "Rackspace"), ("mail.ovh.net", "OVH"), ("zoho.com", "Zoho"), ("zoho.eu", "Zoho"), ("registrar-servers.com", "Namecheap"),
    ("mailspamprotection.com", "SpamExperts"), ("mxthunder.com", "MXRoute"), ("mailgun.org", "Mailgun"), ("sendgrid.net", "SendGrid"), ("amazonses.com", "Amazon SES"),
    ("pphosted.com", "Proofpoint"), ("mimecast.com", "Mimecast"), ("barracudanetworks.com", "Barracuda"), ("inmotionhosting.com", "InMotion"), ("dreamhost.com", "DreamHost"),
    ("pair.com", "pair Networks"), ("1and1.com", "1&1 IONOS"), ("ionos.com", "1&1 IONOS"), ("fastmail.com", "Fastmail"), ("messagingengine.com", "Fastmail"),
    ("protonmail.ch", "ProtonMail"), ("hover.com", "Hover"), ("name.com", "Name.com"), ("netsolmail.net", "Network Solutions"), ("netsol.com", "Network Solutions"),
    ("emailmg.net", "Network Solutions"), ("a2hosting.com", "A2 Hosting"), ("hostmonster.com", "HostMonster"), ("justhost.com", "JustHost"), ("siteground.com", "SiteGround"),
    ("liquidweb.com", "Liquid Web"), ("mediatemple.net", "Media Temple"), ("wpengine.com", "WP Engine"), ("cloudflare.net", "Cloudflare"), ("titan.email", "Titan Email"),
    ("icloud.com", "Apple iCloud"), ("me.com", "Apple iCloud"), ("mac.com", "Apple iCloud"), ("yandex.ru", "Yandex"), ("yandex.net", "Yandex"),
    ("mailru.com", "Mail.ru"), ("qq.com", "Tencent QQ"), ("163.com", "NetEase"), ("126.com", "NetEase"),
)
# Domain lists of the cable report, in order.
CABLE_BUCKETS = (
    ("comcast", "comcast.net comcast.com xfinity.com"),
    ("spectrum", "charter.net charter.com spectrum.net brighthouse.com rr.com twc.com roadrunner.com"),
    ("centurylink", "centurylink.net centurylink.com centurytel.net q.com qwest.net qwest.com embarqmail.com qwestoffice.net uswest.net"),
    ("earthlink", "earthlink.net earthlink.com mindspring.com"),
    ("windstream", "windstream.net windstream.com"),
    ("optimum", "optonline.net optimum.net cablevision.com"),
)
# Host words of the hosting report, in order.
HOSTING_BUCKETS = (("godaddy", "secureserver.net"), ("1and1", "ionos 1and1"), ("hostgator", "hostgator websitewelcome"), ("namecheap", "privateemail.com registrar-servers"), ("zoho", "zoho"), ("cloudflare", "cloudflare.net"))
# Banner rules.
SSH_RULES = (r"OpenSSH_9\.2p1.*Debian.*deb12", r"OpenSSH_9\.2p1.*Debian")
GENERIC_ESMTP = r"^220\s+\S+\s+ESMTP\s*$"
LEGIT_SOFTWARE = "Postfix Microsoft Exchange Google Exim Sendmail Zimbra Dovecot Barracuda Proofpoint Mimecast".split()
# File name words that give the data source (folders first, then names, later ones win over folders).
FOLDER_SOURCES = (("glenndata", "Glenn"), ("newgi", "New GI"), ("email ipost", "iPost"), ("new gi october", "New GI October"), ("gi_jeff", "GI Jeff"), ("sms_emails", "SMS Emails"))
NAME_SOURCES = (
    ("bulldogs", "Bulldogs"), ("bulldog", "Bulldogs"), ("glenn", "Glenn"), ("autoleads", "AutoLeads"), ("auto-leads", "AutoLeads"), ("auto_leads", "AutoLeads"),
    ("jet", "Jet Marketing"), ("jetgi", "Jet Marketing"), ("jet_gi", "Jet Marketing"), ("jetmarketing", "Jet Marketing"), ("ryans", "Ryans Guy"), ("ryan", "Ryans Guy"),
    ("gio", "GIO"), ("ipost", "iPost"), ("ricky", "Ricky Jeff"), ("rickyjeff", "Ricky Jeff"), ("hq4ads", "HQ4Ads"), ("hq4", "HQ4Ads"), ("debt", "Debt Leads"),
    ("flex", "Flex Campaign"), ("140036", "140036 Campaign"), ("aol", "AOL List"), ("yahoo", "Yahoo List"), ("comcast", "Comcast List"), ("hotmail", "Hotmail List"),
    ("master", "Master List"),
)
EXCLUDED_NAMES = "suppress dnc spamhaus blacklist trap block seed federal_dnc do_not donotcall do-not".split()
# Words that exclude a path wherever they stand in it, and words that make a first row a header.
SKIPPED_PATHS = "logs output __pycache__ .git".split()
HEADER_WORDS = "email e-mail name first last fname lname address phone mobile city state zip country carrier gender dob date ip opt".split()
# Display names of public resolvers.
RESOLVERS = {
    "8.8.8.8": "Google-1", "8.8.4.4": "Google-2", "1.1.1.1": "Cloudflare-1", "1.0.0.1": "Cloudflare-2", "208.67.222.222": "OpenDNS-1", "208.67.220.220": "OpenDNS-2",
    "9.9.9.10": "Quad9-1", "149.112.112.10": "Quad9-2", "4.2.2.1": "Level3-1", "4.2.2.2": "Level3-2", "64.6.64.6": "Verisign-1", "64.6.65.6": "Verisign-2",
}
# Header spellings of the fields.
SYNONYMS = {
    "email": ["email", "e-mail", "e_mail", "email_address", "emailaddress", "e-mail address", "email address"],
    "first_name": ["first_name", "firstname", "first name", "fname", "first"],
    "last_name": ["last_name", "lastname", "last name", "lname", "last"],
    "address": ["address", "address1", "street", "street_address", "streetaddress", "formattedaddress"],
    "city": ["city", "town"],
    "state": ["state", "st", "region", "province"],
    "zipcode": ["zipcode", "zip_code", "zip", "zip code", "postalcode", "postal_code", "postal code"],
    "phone": ["phone", "phone_home", "phonehome", "homephone", "mobile", "mobilephone", "telephone", "tel"],
    "dob": ["dob", "dateofbirth", "date_of_birth", "birthdate", "birth_date", "dayofbirth"],
    "gender": ["gender", "sex"],
    "signup_date": ["signup_date", "signupdate", "created_on", "createdon", "creationdate", "creation_date", "date", "signup date"],
    "signup_ip": ["signup_ip", "signupip", "ip_address", "ipaddress", "ip address", "ip"],
    "signup_domain": ["signup_domain", "signupdomain", "signupsource", "signup_source", "source"],
    "validation_status": ["validation_status", "validationstatus", "validationstatusid", "status"],
    "country": ["country"],
}

# Words by which a header cell tells its field when a tree of files is profiled.
FIELD_WORDS = {
    "first_name": ["first_name", "firstname", "first name", "fname", "first"],
    "last_name": ["last_name", "lastname", "last name", "lname", "last"],
    "email": ["email", "e-mail", "email_address", "emailaddress"],
    "phone": ["phone", "telephone", "mobile", "cell"],
    "address": ["address", "street", "address1"],
    "city": ["city", "town"],
    "state": ["state", "st", "province"],
    "zip": ["zip", "zipcode", "postal", "zip_code"],
}
