import re,hashlib
def luhn(d):
    t=0
    for k,x in enumerate(reversed(d)):
        v=int(x)*(2 if k%2 else 1); t+=v-9 if v>9 else v
    return t%10==0
def base(t):
    t=t or ''; out=[]
    for m in re.finditer(r'[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+',t): out.append((m.start(),0,m.end(),'email'))
    for m in re.finditer(r'[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)',t):
        if all(int(p)<=255 for p in m.group().split('.')): out.append((m.start(),1,m.end(),'ip'))
    for m in re.finditer(r'[0-9]([\x20-]?[0-9])+',t):
        d=re.sub('[^0-9]','',m.group())
        if 12<=len(d)<=19 and luhn(d): out.append((m.start(),2,m.end(),'card'))
    for m in re.finditer(r'\+[0-9][\x20().0-9-]+[0-9]',t):
        d=re.sub('[^0-9]','',m.group())
        if 9<=len(d)<=15: out.append((m.start(),3,m.end(),'phone'))
    return sorted(out)
